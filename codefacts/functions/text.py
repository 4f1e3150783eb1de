"""Shared text primitives as native Spark column expressions.

Nothing here runs Python per row: every function returns a ``Column`` built from
``split``, ``regexp_extract_all``, ``substr`` and higher-order functions. The
higher-order parts are interpreted by Spark (they are not code-generated), so
they are kept linear in the number of matches.

Patterns are Java regular expressions. Python's ``\\w`` is Unicode while Java's is
ASCII; patterns that must see non-ASCII identifiers start with ``(?U)``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


FEW_BLOCKS = 2          # matches whose blocks are counted one by one
FEW_LEVELS = 5          # brackets inside each other that a pattern walks over


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], item: str,
         kind: str = "int") -> Column:
    """Running fold: one output of SQL type ``item`` per element of ``values``;
    the state is of SQL type ``kind``.

    ``step(state, value)`` gives the next state and the output. An array that
    grows inside a fold is copied at every step, so outputs are gathered in
    about sqrt(2n) blocks, which are put together at the end.
    """
    def empty(t):
        return F.array().cast(f"array<{t}>")

    def in_block(acc, v):
        s, out = step(acc["s"], v)
        return F.struct(s.alias("s"), F.array_append(acc["out"], out).alias("out"))

    def next_block(done, block):
        last = F.when(F.size(done) > 0, F.element_at(done, -1)["s"]).otherwise(state)
        return F.array_append(done, F.aggregate(block, F.struct(last.alias("s"), empty(item).alias("out")), in_block))

    def blocks(v):
        size = F.greatest(F.ceil(F.sqrt(2 * F.size(v))).cast("int"), F.lit(8))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), size), lambda b: F.slice(v, b, size))
    return F.flatten(F.transform(
        F.aggregate(let(values, blocks), empty(f"struct<s:{kind},out:array<{item}>>"), next_block),
        lambda x: x["out"]))


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an ``ARRAY<INT>``."""
    return scan(values, F.lit(0), lambda s, v: (s + v, s + v), "int")


# --------------------------------------------------------------------------- T1
def finditer(text, pattern: str) -> Column:
    """All non-overlapping matches of ``pattern`` with their 1-based start.

    Returns ``ARRAY<STRUCT<pos: INT, m: STRING>>`` in text order. ``split`` and
    ``regexp_extract_all`` walk the same matcher, so the start of match *k* is one
    plus the length of pieces ``0..k`` and matches ``0..k-1``. This holds for any
    pattern that cannot match the empty string, look-around included.
    """
    text = _c(text)
    ms = F.regexp_extract_all(text, F.lit(pattern), 0)
    # the piece behind the last match has no match beside it and is left out
    cut = F.zip_with(F.split(text, pattern, -1), ms, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
    found = F.filter(cut, lambda x: x["m"].isNotNull())
    return scan(found, F.lit(1),
                lambda at, x: (at + x["gap"] + F.length(x["m"]),
                               F.struct((at + x["gap"]).alias("pos"), x["m"].alias("m"))),
                "struct<pos:int,m:string>")


def first_pos(text, pattern: str) -> Column:
    """1-based start of the first match, 0 when there is none."""
    return F.regexp_instr(_c(text), F.lit(pattern))


def search(text, pattern: str, group: int = 0) -> Column:
    """``re.search(pattern, text).group(group)``; NULL when there is no match.

    An optional group that did not take part in the match comes back as ``''``
    (Java semantics); callers wrap with ``nullif`` where the difference matters.
    """
    text = _c(text)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def findall(text, pattern: str, group: int = 0) -> Column:
    """``re.findall`` for one group: ``ARRAY<STRING>`` in order."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), group)


# --------------------------------------------------------------------------- T2
def _balanced(depth: int, opens: str = r"(\[{", closes: str = r")\]}") -> str:
    """A bracket with all up to its partner, where at most ``depth`` are open at once."""
    free = f"[^{opens}{closes}]"
    pattern = f"[{opens}]{free}*+[{closes}]"
    for _ in range(depth - 1):
        pattern = f"[{opens}](?:{free}++|{pattern})*+[{closes}]"
    return pattern


def block_end(text, start, budget: int | None = None, open_ch: str = "{", close_ch: str = "}") -> Column:
    """Length of the balanced block that starts at ``start`` (1-based).

    Scans to the end of the text (with ``budget``, at most that many characters):
    each ``open_ch`` raises the depth, each ``close_ch`` lowers it, and the block
    ends at the first close that brings the depth back to zero. Returns 0 when
    there is no such close (SURVEY Q11: an unclosed block is empty). For many
    blocks of one text use ``blocks``.
    """
    tail = _c(text).substr(_c(start), F.lit(budget) if budget else F.length(_c(text)))
    pieces = F.split(tail, "(?=[" + "\\" + open_ch + "\\" + close_ch + "])", -1)
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("off"), F.lit(0).alias("end"))

    def step(acc, p):
        first = F.substring(p, 1, 1)
        d = acc["d"] + F.when(first == open_ch, 1).when(first == close_ch, -1).otherwise(0)
        hit = (first == close_ch) & (acc["d"] == 1)
        # nothing is counted behind the end
        return F.when(acc["end"] > 0, acc).otherwise(F.struct(
            d.alias("d"), (acc["off"] + F.length(p)).alias("off"), F.when(hit, acc["off"] + 1).otherwise(0).alias("end")))

    counted = F.coalesce(F.aggregate(pieces, init, step, lambda acc: acc["end"]), F.lit(0))
    # a pattern finds the end of a block of a few levels; others are counted
    return let(F.length(F.regexp_extract(tail, "^" + _balanced(FEW_LEVELS, "\\" + open_ch, "\\" + close_ch), 0)),
               lambda n: F.when(n > 0, n).otherwise(counted))


def balanced(text, start, budget: int | None = None, open_ch: str = "{", close_ch: str = "}") -> Column:
    """Text of the balanced block starting at ``start``; ``''`` when unclosed."""
    n = block_end(text, start, budget, open_ch, close_ch)
    return F.when(n > 0, _c(text).substr(_c(start), n)).otherwise(F.lit(""))


def first_block(text, pattern: str, open_ch: str = "{", close_ch: str = "}", budget: int | None = None) -> Column:
    """Balanced block that the first match of ``pattern`` opens with its last
    character; ``''`` when it never closes, NULL without a match. The text is
    walked to that match only."""
    return let(split_once(text, pattern), lambda p: F.when(F.size(p) > 1, let(
        F.concat(F.lit(open_ch), p[1]), lambda tail: balanced(tail, F.lit(1), budget, open_ch, close_ch))))


def split_once(text, pattern: str) -> Column:
    """The text in front of the first match and behind it; the whole text without one."""
    return F.split(_c(text), pattern, 2)


# --------------------------------------------------------------------------- T3
def before(text, pos, n: int) -> Column:
    """``text[max(0, p-n):p]`` for the 1-based position ``pos`` (= p + 1)."""
    pos = _c(pos)
    lo = F.greatest(F.lit(1), pos - n)
    return _c(text).substr(lo, pos - lo)


def after(text, pos, n: int) -> Column:
    """``text[p:p+n]`` for the 1-based position ``pos``."""
    return _c(text).substr(_c(pos), F.lit(n))


# --------------------------------------------------------------------------- T4
def distinct_matches(text, pattern: str, group: int = 0) -> Column:
    """Order-preserving distinct of all matches of one group (first seen wins)."""
    return F.array_distinct(findall(text, pattern, group))


# --------------------------------------------------------------------------- T5
def contains_any(text, words: Iterable[str]) -> Column:
    """True when any of the literal ``words`` occurs in ``text``."""
    text = _c(text)
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def strip_chars(col, chars: str) -> Column:
    """Python ``str.strip(chars)`` for a small literal character set."""
    cls = "".join("\\" + ch for ch in chars)
    return F.regexp_replace(_c(col), f"^[{cls}]++|(?<![{cls}])[{cls}]++$", "")


def lstrip_chars(col, chars: str) -> Column:
    cls = "".join("\\" + ch for ch in chars)
    return F.regexp_replace(_c(col), f"^[{cls}]+", "")


def strip_ws(col) -> Column:
    """Python ``str.strip()``: removes Unicode white space at both ends.

    Spark's ``trim`` removes only the space character, so it is not used where
    the reference strips tabs and new lines as well.
    """
    return F.regexp_replace(_c(col), r"(?U)^\s++|(?<!\s)\s++$", "")


def groups(text, pattern: str, n: int) -> Column:
    """``re.findall`` with ``n`` groups: ``ARRAY<STRUCT<g1..gn>>`` in match order.

    The text is walked once and the groups are taken from each match. A pattern
    that looks beyond its match (look-around, anchors, possessive repeats) is
    walked once per group instead; the walks are the same, so the arrays align.
    Unmatched optional groups come back as ``''``.
    """
    if not re.search(r"\(\?[=!<]|[*+?}]\+|\$|(?<!\[)\^|\\[bB]", pattern):
        return F.transform(findall(text, pattern, 0), lambda m: F.struct(
            *[F.regexp_extract(m, pattern, i).alias(f"g{i}") for i in range(1, n + 1)]))
    arrs = [findall(text, pattern, i) for i in range(1, n + 1)]
    if n == 1:
        return F.transform(arrs[0], lambda x: F.struct(x.alias("g1")))
    z = F.arrays_zip(*arrs)
    return F.transform(z, lambda s: F.struct(*[s[str(i)].alias(f"g{i + 1}") for i in range(n)]))


def bracket_pairs(text, open_ch: str = "{", close_ch: str = "}") -> Column:
    """``MAP<INT, INT>`` from the 1-based position of every opening bracket to
    the position of its partner.

    The partner of an opening bracket is the first closing bracket that brings
    the depth counted from it back to zero, exactly what ``block_end`` finds;
    a closing bracket with no open partner is ignored. An opening bracket and
    its partner have the same level (the depth inside them) and no bracket of
    that level lies between, so in the order of (level, position) partners are
    neighbours.
    """
    pieces = F.split(_c(text), "(?=[" + "\\" + open_ch + "\\" + close_ch + "])", -1)

    def sized(p):
        first = F.substring(p, 1, 1)
        return F.struct(F.when(first == open_ch, 1).when(first == close_ch, -1).otherwise(0).alias("sign"), F.length(p).alias("n"))

    def step(state, p):
        at, depth, sign = state["at"], state["depth"], p["sign"]
        mark = F.when(sign != 0, F.struct(F.when(sign > 0, depth + 1).otherwise(depth).alias("level"), at.alias("pos"),
                                          (sign > 0).alias("open")))
        return F.struct((at + p["n"]).alias("at"), (depth + sign).alias("depth")), mark

    marks = scan(F.transform(pieces, sized), F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth")), step,
                 "struct<level:int,pos:int,open:boolean>", "struct<at:int,depth:int>")

    def partners(xs):
        def one(x, i):
            y = F.get(xs, i + 1)
            return F.when(x["open"] & ~y["open"] & (y["level"] == x["level"]),
                          F.struct(x["pos"].alias("o"), y["pos"].alias("c")))
        return F.map_from_entries(F.filter(F.transform(xs, one), lambda e: e.isNotNull()))
    return let(F.sort_array(F.filter(marks, lambda x: x.isNotNull())), partners)


def pair_len(pairs: Column, start) -> Column:
    """Length of the block opening at ``start`` given ``bracket_pairs``; 0 when
    it never closes."""
    start = _c(start)
    close = F.try_element_at(pairs, start)
    return F.coalesce(close - start + 1, F.lit(0))


def blocks(text, pattern: str, open_ch: str = "{", close_ch: str = "}", open_first: bool = False,
           keep_header: bool = False, budget: int | None = None) -> Column:
    """Every match of ``pattern`` with the balanced block that it opens:
    ``ARRAY<STRUCT<pos: INT, m: STRING, body: STRING>>``.

    The opening bracket is the match's last character (``open_first``: its
    first); the body runs from there to the partner, from the match's start if
    ``keep_header``. It is ``''`` if the bracket never closes or, only where a
    ``budget`` is given, if the body is longer. One pass finds all partners (for
    up to ``FEW_BLOCKS`` matches one per match), and only the blocks are carried
    on, not the text.
    """
    text = _c(text)

    def bodies(found, close_of):
        def one(h):
            at = h["pos"] if open_first else h["pos"] + F.length(h["m"]) - 1
            start = h["pos"] if keep_header else at

            def cut(n):
                fits = (n > 0) & (n <= budget) if budget else n > 0
                return F.struct(h["pos"].alias("pos"), h["m"].alias("m"),
                                F.when(fits, F.substring(text, start, n)).otherwise(F.lit("")).alias("body"))
            return let(F.coalesce(close_of(at) - start + 1, F.lit(0)), cut)
        return F.transform(found, one)

    def single(at):
        """Partner of the bracket at ``at``; null if it has none."""
        return F.nullif(block_end(text, at, None, open_ch, close_ch), F.lit(0)) + at - 1

    def of_matches(found):
        # for a few blocks a count from each is less work than the partners of all brackets
        return F.when(F.size(found) <= FEW_BLOCKS, bodies(found, single)).otherwise(
            let(bracket_pairs(text, open_ch, close_ch), lambda pairs: bodies(found, lambda at: F.try_element_at(pairs, at))))
    # texts without a match need no brackets
    return F.when(text.rlike(pattern), let(finditer(text, pattern), of_matches))


# --------------------------------------------------------------------------- nesting
def marks(text, separators: str = "") -> Column:
    """The text cut in front of every bracket of ``()[]{}`` and every character of
    ``separators``: ``ARRAY<STRUCT<level: INT, pos: INT, m: STRING>>`` in text order,
    ``m`` being the piece and ``pos`` its place. ``level`` is the bracket depth
    around the piece's first character, for a closing bracket that of its opening
    one; a closing bracket without a partner is ignored. The piece in front of the
    first cut comes first."""
    def step(s, p):
        first = F.substring(p, 1, 1)
        opens, closes = first.isin("(", "[", "{"), first.isin(")", "]", "}")
        level = F.when(closes, F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"])
        return (F.struct((s["at"] + F.length(p)).alias("at"), F.when(opens, s["depth"] + 1).otherwise(level).alias("depth")),
                F.struct(level.alias("level"), s["at"].alias("pos"), p.alias("m")))
    pieces = F.split(_c(text), r"(?=[()\[\]{}" + separators + "])", -1)
    return scan(pieces, F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth")), step,
                "struct<level:int,pos:int,m:string>", "struct<at:int,depth:int>")


def top_pieces(text, separators: str) -> Column:
    """The pieces of ``text`` between those of the characters ``separators`` that
    stand outside all brackets: ``ARRAY<STRUCT<pos: INT, n: INT>>``.

    One walk takes whole runs without a separator, brackets up to ``FEW_LEVELS``
    deep included; the brackets around deeper ones, and those without a partner,
    are counted.
    """
    text = _c(text)
    tokens = F.regexp_extract_all(text, F.lit(
        rf"(?:[^()\[\]{{}}{separators}]++|{_balanced(FEW_LEVELS)})++|[()\[\]{{}}{separators}]"), 0)

    def step(s, t):
        first, n = F.substring(t, 1, 1), F.length(t)
        one = n == 1
        depth = (F.when(one & first.isin("(", "[", "{"), s["depth"] + 1)
                 .when(one & first.isin(")", "]", "}"), F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"]))
        cut = F.when(one & (s["depth"] == 0) & t.rlike("[" + separators + "]"), s["at"])
        return F.struct((s["at"] + n).alias("at"), depth.alias("depth")), cut

    def pieces(cuts):
        starts = F.concat(F.array(F.lit(1)), F.transform(cuts, lambda c: c + 1))
        ends = F.concat(cuts, F.array(F.length(text) + 1))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("pos"), (e - s).alias("n")))
    cuts = scan(tokens, F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth")), step, "int", "struct<at:int,depth:int>")
    return let(F.filter(cuts, lambda c: c.isNotNull()), pieces)
