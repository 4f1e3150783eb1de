"""Generated Go sources, one file per ``part`` row (``go/p<k>.go``).

For k = p_partkey, z = p_size, h = k div 2, t = k div 3 the file holds:

* imports ``errors``, ``fmt`` (grouped) and ``net/http`` (single);
* consts ``Kind<k> Status = p_type``, ``Size<k> = z``, ``Spare<k>`` (no value),
  and ``Name<k>, Code<k> = p_name, k`` on one line;
* a request struct ``get<k>Param`` when k % 3 = 0, ``Get<k>Param`` when
  k % 3 = 1, none when k % 3 = 2; fields ``ID, Alt int64`` (one tag),
  ``Name string`` (omitempty), ``Price float64`` (a quoted comment, no tag),
  embedded ``Base``, ``Next *<param of h>`` and, when z % 4 = 0, a
  ``Session sessionID``; a response struct ``Get<k>Resp`` when k is even;
* an interface ``Store<k>`` with two methods and an embedded interface;
* in ``go/p0.go`` only, the shared ``Base`` struct (``Version int``) that every
  request struct embeds (promoted fields, E11);
* handler ``(h *Handler) Get<k>`` with a DB call, an error, plain calls
  (``F<h>``, ``len``, ``svc.F<t>``, ``fmt.Sprintf``, ``http.Get``) and an
  unchained router call; ``F<k>`` calling ``F<h>``.

Braces and parentheses inside strings and comments are decoys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.plans.corpus_client import fill, spread, when_text
from codefacts.sources.tables import table

GO_FILE = """package p@@k@@

import (
\t"errors"
\t"fmt" // formatting (
)

import "net/http"

// Get@@k@@ serves part @@k@@ { a brace in a comment
const (
\tKind@@k@@ Status = "@@ptype@@"
\tSize@@k@@ = @@z@@
\tSpare@@k@@
)

const Name@@k@@, Code@@k@@ = "@@name@@", @@k@@
@@base@@@@param@@@@resp@@
type Store@@k@@ interface {
\tLoad(id int64) (string, error)
\tSave(p *Base) error
\tBase
}

func (h *Handler) Get@@k@@(w http.ResponseWriter, r *http.Request) (map[string]interface{}, error) {
\trows, err := db.Query("SELECT * FROM t WHERE id = ?", @@k@@)
\tif err != nil {
\t\treturn nil, errors.New("part @@k@@ not found")
\t}
\ts := "} not a call("
\tv := F@@half@@(len(s))
\tsvc.F@@third@@(fmt.Sprintf("%d", v))
\tr.GET("/p/@@k@@", h.Get@@k@@)
\thttp.Get("http://x/@@k@@")
\treturn nil, nil
}

func F@@k@@(x int) int {
\tif x > @@z@@ {
\t\treturn F@@half@@(x - 1)
\t}
\treturn x
}
"""

PARAM = """
type @@pname@@ struct {
\tID, Alt int64 `json:"id"`
\tName string `json:"name,omitempty"`
\tPrice float64 // "not a tag"
\tBase
\tNext *@@next@@
@@session@@}
"""
BASE = """
type Base struct {
\tVersion int
}
"""
RESP = """
type Get@@k@@Resp struct {
\tTotal int `json:"total"`
\tItems []*@@pname@@ `json:"items"`
}
"""


def param_name(k):
    """Request struct name planted for part k (NULL when k % 3 = 2)."""
    ks = k.cast("string")
    return (F.when(k % 3 == 0, F.concat(F.lit("get"), ks, F.lit("Param")))
            .when(k % 3 == 1, F.concat(F.lit("Get"), ks, F.lit("Param"))))


def go_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size"))
    k, z = F.col("p_partkey"), F.col("p_size")
    half, third = F.floor(k / 2), F.floor(k / 3)
    pname = param_name(k)
    next_name = F.coalesce(param_name(half), F.concat(F.lit("Missing"), half.cast("string")))
    param = when_text(pname.isNotNull(), fill(PARAM, pname=pname, next=next_name,
                                              session=when_text(z % 4 == 0, "\tSession sessionID\n")))
    resp = when_text(k % 2 == 0, fill(RESP, k=k, pname=F.coalesce(pname, F.lit("Base"))))
    content = fill(GO_FILE, k=k, z=z, half=half, third=third, name=F.col("p_name"),
                   ptype=F.col("p_type"), param=param, resp=resp, base=when_text(k == 0, BASE))
    return p.select(F.concat(F.lit("go/p"), k.cast("string"), F.lit(".go")).alias("path"),
                    content.alias("content"))


# One more file per part (``nest/p<k>.go``): declarations inside declarations and
# calls on results. For k, z, h, t as above it holds ``Outer<k>`` (with an
# anonymous struct that holds another one when z is even), ``Side<k>`` (type
# parameters) and ``Port<k>`` in one group, a struct declared inside a function,
# constants whose values hold commas in brackets and strings, and ``Chain<k>``.
# Decoys: anonymous structs of a variable and of a parameter, conversions, a type
# assertion, parenthesised results of a function literal.
NEST_FILE = """package p@@k@@

type (
	Outer@@k@@ struct {
		A@@k@@, B int `json:"a"`
		Meta struct {
			Name string `json:"n@@z@@"` // "no tag"
@@deep@@		} `json:"meta"`
		Call func(a int,
			b string) (int, error)
		Base
	}
	Side@@k@@[K comparable, V []int] struct { Keys []K; Vals map[string]V }
	Port@@k@@ interface {
		Do(f func(int) (string, error), n int) error; Close()
		Base
	}
)

const A@@k@@, B@@k@@ = f(@@z@@, 2), "x, @@name@@"
const (
	C@@k@@ time.Duration = g(1,
		@@k@@)
	D@@k@@, E@@k@@ = "", []int{1, @@z@@}[0]
)

func Chain@@k@@(p struct{ N int }) error {
	type loc@@k@@ struct { W@@z@@ int }
	var v struct { Hidden int }
	open@@k@@(@@z@@).where("a, (b").
		done(x.(T).get(@@k@@))
	m[@@z@@](2); h[int, T@@k@@](x)
	b := []byte(string(v.Hidden))
	func(n int) (int, error) { return in@@k@@(n), nil }(@@z@@)
	return (wrap)(b)
}
"""
NEST_DEEP = "\t\t\tPos, End struct { Line@@z@@ []int }\n"


def nest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    k, z = F.col("p_partkey"), F.col("p_size")
    content = fill(NEST_FILE, k=k, z=z, name=F.col("p_name"), deep=when_text(z % 2 == 0, fill(NEST_DEEP, z=z)))
    return p.select(F.concat(F.lit("nest/p"), k.cast("string"), F.lit(".go")).alias("path"), content.alias("content"))
