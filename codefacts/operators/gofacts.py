"""Backend (Go) facts without a syntax tree, SURVEY G1-G13.

Recipe, all native Spark expressions:

1. ``mask``: string literals and comments are replaced by blanks of equal
   length (new lines kept), so brace counting and call detection never see
   them, while positions still index the raw text.
2. Functions are found on the masked text: ``func`` headers at line start,
   parameter lists by balanced parentheses, the body by balanced braces
   (``interface{...}`` / ``struct{...}`` in a result list are stepped over).
3. Other declarations are the pieces of the text between line ends (and ``;``)
   outside all brackets, their specs the pieces inside ``( ... )``, their values
   the pieces between commas: always at bracket depth 0 of what is cut. The
   fields of a struct are the pieces directly inside its braces, so those of an
   anonymous struct belong to the field that holds it.
4. Calls are parentheses behind an operand. Tokens are put in the order (depth,
   position), where the closing bracket stands right behind its opening one, so
   one fold follows a postfix chain (selectors, calls, indexes, assertions,
   literals) and knows where each operand began.

Fidelity limits (a syntax tree sees more): an index made of names only
(``m[k](x)``) is read as type arguments, the preference of the parser that the
analysed tool uses; labels and declarations are not told from expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts import params as P
from codefacts.functions import text as T
from codefacts.session import cut as cut_lineage
from codefacts.session import shuffled

# ----------------------------------------------------------------------------
# Go lexical patterns and keyword stop list
# ----------------------------------------------------------------------------
# groups repeat possessively: Java runs those as a loop, a plain group takes stack per repetition
RX_LITERAL = (r"""(?=["'`/])(?:"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|`[^`]*`|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"""
              r"|//[^\n]*|/\*[\s\S]*?\*/)")
RX_FUNC = r"(?mU)^func\s*(\([^)]*\))?\s*(\w+)\s*(?:\[[^\]]*\])?\s*\("
RX_RESULT = r"(?U)^((?:\b(?:interface|struct)\s*\{[^{}]*\}|[^{}\n])*+)\{"
RX_WORDS = r"(?<!\w)[A-Za-z_]\w*+(?:\s*+\.\s*+[A-Za-z_]\w*+)*+"
RX_TAIL = r"(?U)((?:(?<=^|^[ \t])\.\s*+)?+" + RX_WORDS + r")\s*?(\.?)\s*+$"
RX_WHOLE = r"(?U)^[ \t*]*+" + RX_WORDS + r"[ \t]*+$"
CALL_KEYWORDS = ["func", "if", "for", "switch", "return", "select", "case", "go", "defer",
                 "range", "else", "var", "const", "type", "import", "package", "struct",
                 "interface", "map", "chan"]
RX_DQ_STRING = r'"((?:[^"\\\n]|\\.)*+)"'
RX_PARAMS = r"(?:\[(?:[^\[\]]|\[[^\[\]]*\])*+\])?"
RX_STRUCT = r"(?U)(?:\btype\s+)?+\b(\w++)\s*" + RX_PARAMS + r"\s+(struct)\s*\{"
RX_INTERFACE = r"(?Us)^\s*(\w+)\s*" + RX_PARAMS + r"\s+interface\s*(\{.*\})\s*$"
RX_NAMES = r"(?U)^\s*+(\w+(?:\s*,\s*\w+)*+)"
RX_FIELD = RX_NAMES[:-1] + r"\s++)(?=\S)"
RX_TYPE_ARGS = r"(?U)^\s*[A-Za-z_*\[][\w.*\[\]\s,]*$"
RX_TAG = r'(`[^`]*`|"(?:[^"\\]|\\.)*+")'
RX_METHOD_SPEC = r"(?U)^\s*(\w+)\s*\("
RX_IMPORT = r"(?mU)^import\s*(\(|(?:[\w.]+\s+)?\"[^\"]*\")"
RX_IMPORT_PATH = r'"([^"]*)"'
RX_CONST_TYPE = r"(?U)^\s*([A-Za-z_]\w*)\s*$"


def _blank(s: Column) -> Column:
    return F.when(s.contains("\n"), F.regexp_replace(s, r"[^\n]", " ")).otherwise(F.repeat(F.lit(" "), F.length(s)))


def _lexed(c: Column) -> Column:
    """A text cut at its comments and literals: the pieces between them and these tokens."""
    return F.struct(F.split(c, RX_LITERAL, -1).alias("pieces"), F.regexp_extract_all(c, F.lit(RX_LITERAL), 0).alias("toks"))


def _mask(c: Column, lexed: Column, keep_strings: bool = False) -> Column:
    pieces, toks = lexed["pieces"], lexed["toks"]

    def repl(t):
        if keep_strings:
            return F.when(t.startswith("//") | t.startswith("/*"), _blank(t)).otherwise(t)
        return _blank(t)

    joined = F.zip_with(F.slice(pieces, 1, F.size(toks)), toks, lambda p, t: F.concat(p, repl(t)))
    tail = F.coalesce(F.try_element_at(pieces, F.size(pieces)), F.lit(""))
    return F.when(F.size(toks) == 0, c).otherwise(F.concat(F.array_join(joined, ""), tail))


def mask(content, keep_strings: bool = False) -> Column:
    """``content`` with comments (and, unless ``keep_strings``, string and rune
    literals) replaced by spaces of equal length; new lines are kept.

    ``split`` and ``regexp_extract_all`` over the same lexical pattern give the
    text between tokens and the tokens themselves, so the masked text is one
    pass over the file (no per-token copy of the whole text).
    """
    c = F.col(content) if isinstance(content, str) else content
    return T.let(_lexed(c), lambda lexed: _mask(c, lexed, keep_strings))


def masked_files(files: DataFrame) -> DataFrame:
    """``(path, content, masked, nocomment)``: each file with its masked texts,
    both from one cut of the text."""
    c, lexed = F.col("content"), F.col("_lexed")
    return (files.select("path", "content", _lexed(c).alias("_lexed"))
            .select("path", "content", _mask(c, lexed).alias("masked"), _mask(c, lexed, keep_strings=True).alias("nocomment")))


# ------------------------------------------------------------------ G1, G2
def functions(mf: DataFrame) -> DataFrame:
    """``(path, ord, function_name, receiver, signature, body, masked_body)``.

    ``signature`` = ``func `` + receiver + name + params + result, trimmed. The
    spans are found inside the row; only the pieces are exploded, not the file.
    """
    return _function_rows(mf, _function_spans())


def _function_spans() -> Column:
    raw, masked = F.col("content"), F.col("masked")

    def header(params_len):
        def one(h):
            open_at = h["pos"] + F.length(h["m"]) - 1
            n = params_len(open_at)
            return F.struct(h["m"].alias("m"), open_at.alias("at"), n.alias("n_params"),
                            T.search(F.substring(masked, open_at + n, F.length(masked)), RX_RESULT, 0).alias("res"))
        return one

    def parts(body_len):
        def one(h):
            behind = h["at"] + h["n_params"]
            body_at = behind + F.length(h["res"]) - 1
            n = F.coalesce(body_len(body_at), F.lit(0))
            return F.struct(
                h["m"].alias("m"), h["n_params"].alias("n_params"),
                F.substring(raw, h["at"], h["n_params"]).alias("params"),
                F.coalesce(F.substring(raw, behind, F.length(h["res"]) - 1), F.lit("")).alias("result"),
                F.when(n > 0, F.substring(raw, body_at, n)).alias("body"),
                F.when(n > 0, F.substring(masked, body_at, n)).alias("masked_body"))
        return one

    def spans(headers, params_len, body_len):
        return F.transform(F.transform(headers, header(params_len)), parts(body_len))

    def of_headers(headers):
        # for a few functions a search from each is less work than the partners of all brackets
        pairs = F.struct(T.bracket_pairs(masked, "(", ")").alias("parens"), T.bracket_pairs(masked).alias("braces"))
        few = spans(headers, lambda at: T.block_end(masked, at, None, "(", ")"), lambda at: T.block_end(masked, at))
        return F.when(F.size(headers) <= T.FEW_BLOCKS, few).otherwise(T.let(pairs, lambda p: spans(
            headers, lambda at: T.pair_len(p["parens"], at), lambda at: T.pair_len(p["braces"], at))))

    found = T.let(T.finditer(masked, RX_FUNC), of_headers)
    # a test in front of the generator, since a filter would be pushed below the masking and mask twice
    return F.when(masked.rlike(RX_FUNC), F.filter(found, lambda h: h["n_params"] > 0))


def _function_rows(df: DataFrame, spans: Column) -> DataFrame:
    h = df.select("path", F.posexplode(spans).alias("ord", "h"))
    recv = F.regexp_extract("h.m", RX_FUNC, 1)
    name = F.regexp_extract("h.m", RX_FUNC, 2)
    sig = T.strip_ws(F.concat(F.lit("func "), F.when(recv != "", F.concat(recv, F.lit(" "))).otherwise(F.lit("")),
                              name, F.col("h.params"), F.lit(" "), T.strip_ws("h.result")))
    return h.select("path", F.col("ord").cast("int").alias("ord"), name.alias("function_name"),
                    F.nullif(recv, F.lit("")).alias("receiver"), sig.alias("signature"),
                    F.col("h.body").alias("body"), F.col("h.masked_body").alias("masked_body"))


# ------------------------------------------------------------------ G3-G7
NOTHING, OPERAND, TYPE, DOT = 0, 1, 2, 3        # what stands in front of a bracket
# what the text between two brackets does to it
BLANK, MEMBER, ASSERT, NAME, NAME_DOT, NAMED_TYPE, OTHER_TYPE, FUNC, BREAK = range(9)


def _gap(text: Column, at: Column) -> Column:
    """The text between two brackets: its class, the place of the operand or word
    at its end, whether there is nothing else, and whether it ends a function
    signature."""
    def one(tail):
        # a chain of words ends with a word character, only blanks and a dot stand behind it
        chain = F.regexp_extract(tail, r"(?Us)^.*\w", 0)
        worded = T.let(chain, lambda w: (
            F.when(w.isin("interface", "struct"), NAMED_TYPE)
            .when(w.isin("map", "chan"), OTHER_TYPE)
            .when(w == "func", FUNC)
            .when(w.isin(*CALL_KEYWORDS), BREAK)
            .when(tail.rlike(r"(?U)\.\s*+$"), NAME_DOT).otherwise(NAME)))
        kind = (F.when((text == "") | text.rlike(r"^[ \t]*$"), BLANK)
                .when(text.rlike(r"^[ \t]*\.\s*$"), ASSERT)
                .when(tail == "", BREAK)
                .when(tail.startswith("."), MEMBER).otherwise(worded))
        return F.struct(kind.alias("kind"), (at + F.length(text) - F.length(tail)).alias("at"),
                        ((text != "") & text.rlike(RX_WHOLE)).alias("whole"), text.rlike(r"[\n,=;:]").alias("breaks"))
    return T.let(F.when(text == "", "").otherwise(F.regexp_extract(text, RX_TAIL, 0)), one)


def call_sites(masked: Column) -> Column:
    """Calls in a masked body as ``ARRAY<STRUCT<start, back, open, idx>>`` with
    nulls between them: where the callee starts, minus the position of the
    closing parenthesis (an outer call sorts before the inner one that starts
    with it), the opening one, and the index right before that (0: none).

    A fold over the brackets in the order (depth, position), each with the text
    behind it. Its state: what stands before (``k``), where that operand or type
    began (``start``), the ``func`` keyword of a function literal whose body has
    not come yet (``fn``), the last index, whether ``struct`` or ``interface``
    stands before, and the call whose parenthesis is open.
    """
    def entries(t):
        b, behind = F.substring(t["m"], 1, 1), F.substring(t["m"], F.lit(2), F.length(t["m"]))
        opens, none = b.isin("(", "[", "{"), F.struct(F.lit(BLANK).alias("kind"), F.lit(0).alias("at"), F.lit(False).alias("whole"),
                                                      F.lit(False).alias("breaks"))

        def entry(level, pos, mark, gap):
            return F.struct(level.alias("level"), pos.alias("pos"), mark.alias("b"), gap.alias("gap"))
        closes = b.isin(")", "]", "}")
        return (F.when(opens, F.array(entry(t["level"], t["pos"], b, none),
                                      entry(t["level"] + 1, t["pos"], F.lit(""), _gap(behind, t["pos"] + 1))))
                .when(closes, F.array(entry(t["level"], t["pos"], b, _gap(behind, t["pos"] + 1))))
                .otherwise(F.array(entry(t["level"], t["pos"], F.lit(""), _gap(t["m"], t["pos"])))))

    def step(s, t):
        b, gap = t["b"], t["gap"]
        kind, at = gap["kind"], gap["at"]
        opens, reset = b.isin("(", "[", "{"), b == ""
        k, start = F.when(reset, NOTHING).otherwise(s["k"]), F.when(reset, 0).otherwise(s["start"])
        fn = F.when(reset | gap["breaks"], 0).otherwise(s["fn"])
        pending, operand = fn > 0, k == OPERAND
        call = (b == "(") & ~pending & operand
        goes_on = gap["whole"] & (k == TYPE)              # []byte, []*T, map[K]struct
        k_open = (F.when((b == "{") & s["named"], F.when(pending, k).otherwise(TYPE))
                  .when((b == "{") & pending, OPERAND)
                  .when(pending, k).when(b == "(", OPERAND)
                  .when(b == "[", F.when(operand, OPERAND).otherwise(TYPE))
                  .otherwise(F.when(k.isin(OPERAND, TYPE), OPERAND).otherwise(NOTHING)))
        start_open = (F.when((b == "{") & pending & ~s["named"], fn)
                      .when(~pending & (k == NOTHING) & (b != "{"), t["pos"]).otherwise(start))
        is_type = kind.isin(NAMED_TYPE, OTHER_TYPE)
        k_gap = (F.when(kind == BLANK, k).when(kind == MEMBER, OPERAND).when(kind == NAME_DOT, DOT)
                 .when(kind == ASSERT, F.when(operand, DOT).otherwise(NOTHING))
                 .when(kind == NAME, F.when(goes_on, TYPE).when(pending, NOTHING).otherwise(OPERAND))
                 .when(is_type, F.when(pending, NOTHING).otherwise(TYPE)).otherwise(NOTHING))
        stays = kind.isin(BLANK, ASSERT) | ((kind == MEMBER) & operand) | goes_on
        fn_gap = F.when((kind == FUNC) & ~pending, at).otherwise(fn)
        state = F.struct(
            F.when(opens, k_open).otherwise(k_gap).alias("k"),
            F.when(opens, start_open).when(stays, start).otherwise(at).alias("start"),
            F.when((b == "{") & ~s["named"], 0).when(opens, fn).otherwise(fn_gap).alias("fn"),
            F.when((b == "[") & operand & ~pending, t["pos"]).when(~opens & ~reset & (kind == BLANK), s["idx"]).otherwise(0).alias("idx"),
            (~opens & (kind == NAMED_TYPE)).alias("named"),
            F.when(call, start).otherwise(0).alias("call"), F.when(call, t["pos"]).otherwise(0).alias("open"),
            F.when(call, s["idx"]).otherwise(0).alias("call_idx"))
        out = F.when((b == ")") & (s["call"] > 0), F.struct(
            s["call"].alias("start"), (-t["pos"]).alias("back"), s["open"].alias("open"), s["call_idx"].alias("idx")))
        return state, out

    zero = F.lit(0)
    start = F.struct(*[zero.alias(c) for c in ("k", "start", "fn", "idx")], F.lit(False).alias("named"),
                     *[zero.alias(c) for c in ("call", "open", "call_idx")])
    tokens = F.sort_array(F.flatten(F.transform(T.marks(masked), entries)))
    return T.scan(tokens, start, step, "struct<start:int,back:int,open:int,idx:int>",
                  "struct<k:int,start:int,fn:int,idx:int,named:boolean,call:int,open:int,call_idx:int>")


def calls(fns: DataFrame, router=P.ROUTER_PATTERNS, db=P.DB_PATTERNS, http=P.HTTP_CLIENT_PATTERNS,
          errors=P.ERROR_CONSTRUCTORS) -> DataFrame:
    """Every call in a body with its 4-way class, an outer call before the
    calls inside it.

    ``(path, function_ord, function_name, ord, kind, callee, full_call)``,
    kind in router > db > error > call. The router test runs on the callee
    text plus ``(`` (SURVEY Q3), the DB test on the full call after the
    HTTP-client veto, the error test on the callee.
    """
    body, masked = F.col("body"), F.col("masked_body")

    def one(x):
        index = F.substring(masked, x["idx"] + 1, x["open"] - x["idx"])
        index = F.regexp_replace(index, r"\]\s*\($", "")
        end = F.when((x["idx"] > 0) & index.rlike(RX_TYPE_ARGS), x["idx"]).otherwise(x["open"])
        return F.struct(T.strip_ws(F.substring(body, x["start"], end - x["start"])).alias("callee"),
                        F.substring(body, x["start"], -x["back"] - x["start"] + 1).alias("full_call"))
    found = F.transform(F.sort_array(F.filter(call_sites(masked), lambda x: x.isNotNull())), one)
    c = (fns.where(masked.isNotNull())
         .select("path", F.col("ord").alias("function_ord"), "function_name", F.posexplode(found).alias("ord", "h"))
         .select("path", "function_ord", "function_name", F.col("ord").cast("int").alias("ord"),
                 "h.callee", "h.full_call"))
    is_router = T.contains_any(F.concat(F.col("callee"), F.lit("(")), router)
    is_db = ~T.contains_any("full_call", http) & T.contains_any("full_call", db)
    is_err = T.contains_any("callee", errors)
    kind = (F.when(is_router, "router").when(is_db, "db").when(is_err, "error").otherwise("call"))
    return c.withColumn("kind", kind)


def error_messages(calls_df: DataFrame) -> DataFrame:
    """Double-quoted literals inside error-constructor calls (raw string
    literals excluded): ``(path, function_ord, function_name, message)``."""
    e = calls_df.where(F.col("kind") == "error")
    return e.select("path", "function_ord", "function_name",
                    F.explode(T.findall("full_call", RX_DQ_STRING, 1)).alias("message"))


def function_sets(calls_df: DataFrame) -> DataFrame:
    """Per definition, the distinct values of each kind (unordered):
    ``(path, function_ord, function_name, kind, value)`` where value is the
    callee for plain calls, each message for errors, else the full call.

    One pass over the calls: every call row becomes an array of
    ``(kind, value)`` pairs that is exploded, then de-duplicated.
    """
    k = F.col("kind")
    pairs = (F.when(k == "call", F.array(F.struct(k.alias("kind"), F.col("callee").alias("value"))))
             .when(k == "error", F.transform(T.findall("full_call", RX_DQ_STRING, 1),
                                             lambda m: F.struct(F.lit("error").alias("kind"), m.alias("value"))))
             .otherwise(F.array(F.struct(k.alias("kind"), F.col("full_call").alias("value")))))
    return (calls_df.select("path", "function_ord", "function_name", F.explode(pairs).alias("p"))
            .select("path", "function_ord", "function_name", "p.kind", "p.value").distinct())


# ------------------------------------------------------------------ specs
def _specs(mf: DataFrame, *keywords: str, separators: str = r"\n;") -> DataFrame:
    """Specs of the top-level declarations of ``keywords``, single or in
    parentheses: ``(path, pos, keyword, masked, nocomment, content)``, ``pos`` being
    the spec's place in the file."""
    return _spec_rows(mf, _spec_spans(*keywords, separators=separators))


def _spec_spans(*keywords: str, separators: str = r"\n;") -> Column:
    masked = F.col("masked")
    one_of = "|".join(keywords)
    starts = rf"(?U)^\s*(?:{one_of})\b"

    def inner(p):
        """Place of a declaration's specs, without keyword and parentheses."""
        text = F.substring(masked, p["pos"], p["n"])
        head = F.regexp_extract(text, starts + r"\s*\(?", 0)
        grouped = head.endswith("(")
        tail = F.when(grouped, F.length(F.regexp_extract(text, r"\)?\s*$", 0))).otherwise(0)
        return F.struct((p["pos"] + F.length(head)).alias("pos"), (p["n"] - F.length(head) - tail).alias("n"),
                        F.regexp_extract(head, rf"({one_of})", 1).alias("keyword"))

    def pieces(d):
        return F.transform(T.top_pieces(F.substring(masked, d["pos"], d["n"]), separators),
                           lambda p: F.struct((d["pos"] + p["pos"] - 1).alias("pos"), p["n"].alias("n"), d["keyword"].alias("keyword")))
    declared = F.filter(T.top_pieces(masked, separators), lambda p: F.substring(masked, p["pos"], p["n"]).rlike(starts))
    specs = F.flatten(F.transform(F.transform(declared, inner), pieces))

    def cut(p):
        return F.struct(p["pos"].alias("pos"), p["keyword"].alias("keyword"), *[
            F.substring(F.col(c), p["pos"], p["n"]).alias(c) for c in ("masked", "nocomment", "content")])
    return F.when(masked.rlike(rf"(?U)\b(?:{one_of})\b"), F.filter(F.transform(specs, cut), lambda s: T.strip_ws(s["masked"]) != ""))


def _spec_rows(df: DataFrame, spans: Column) -> DataFrame:
    return df.select("path", F.explode(spans).alias("s")).select("path", "s.*")


def _names(text: Column) -> Column:
    """Names in front of a spec with their places."""
    return T.finditer(F.regexp_extract(text, RX_NAMES, 1), r"(?U)\w+")


# ------------------------------------------------------------------ G9
def structs(mf: DataFrame) -> DataFrame:
    """``(path, ord, name, body, body_masked)``; body is the struct type
    text from ``struct`` to its closing brace. Types declared inside functions
    and in ``type ( ... )`` are found too, anonymous structs of fields,
    variables and parameters are not declarations."""
    return _struct_rows(mf, _struct_spans())


def _struct_spans() -> Column:
    masked = F.col("masked")

    def one(h):
        at = h["pos"] + F.length(h["m"]) - F.length(F.regexp_extract(h["m"], r"struct\s*\{$", 0))
        n = h["pos"] + F.length(h["m"]) - 1 + F.length(h["body"]) - at
        open_at = h["pos"] + F.length(h["m"]) - 1
        return F.struct(
            F.regexp_extract(h["m"], RX_STRUCT, 1).alias("name"), h["body"].alias("_mblock"),
            F.substring(F.col("content"), at, n).alias("body"), F.substring(masked, at, n).alias("body_masked"),
            F.substring(F.col("nocomment"), open_at, F.length(h["body"])).alias("_rblock"),
            F.substring(F.col("content"), open_at, F.length(h["body"])).alias("_cblock"))

    def grouped():
        """Places of the specs directly inside ``type ( ... )``, where each starts."""
        def of_group(g):
            return F.transform(T.top_pieces(F.substring(g["body"], F.lit(2), F.length(g["body"]) - 2), r"\n;"), lambda p: (
                g["pos"] + F.length(g["m"]) + p["pos"] - 1
                + F.length(F.regexp_extract(F.substring(g["body"], p["pos"] + 1, p["n"]), r"(?U)^\s*", 0))))
        groups = T.blocks(masked, r"(?U)\btype\s*\(", "(", ")")
        return F.when(masked.rlike(r"(?U)\btype\s*\("), F.flatten(F.transform(groups, of_group))).otherwise(
            F.array().cast("array<int>"))

    def declared(starts):
        return F.filter(T.blocks(masked, RX_STRUCT), lambda h: (h["body"] != "") & (
            h["m"].rlike(r"(?U)^type\s") | F.array_contains(starts, h["pos"])))
    return F.when(masked.rlike(RX_STRUCT), F.transform(T.let(grouped(), declared), one))


def _struct_rows(df: DataFrame, spans: Column) -> DataFrame:
    return (df.select("path", F.posexplode(spans).alias("ord", "s"))
            .select("path", F.col("ord").cast("int").alias("ord"), "s.name", "s.body", "s.body_masked",
                    "s._mblock", "s._rblock", "s._cblock"))


def _field_pieces() -> Column:
    """From the marks of a struct's braces (column ``_marks``): what stands directly inside the braces of a struct and of the anonymous
    structs in it: ``ARRAY<STRUCT<link, own, cut, end, level>>``. Pieces have
    ``link`` 0 and run from ``cut`` + 1 to ``end`` - 1 inside the braces opened at
    ``own``; a link says that the struct opened at ``link`` stands in the piece
    of ``own`` that begins behind ``cut``."""
    def entries(t, i):
        b = F.substring(t["m"], 1, 1)
        struct = (t["pos"] == 1) | F.coalesce(F.get(tokens, i - 1)["m"].rlike(r"(?U)\bstruct\s*$"), F.lit(False))

        def entry(level, kind):
            return F.struct(level.alias("level"), t["pos"].alias("pos"), F.lit(kind).alias("kind"), struct.alias("struct"))
        return (F.when(b.isin("(", "[", "{"), F.array(entry(t["level"], "open"), entry(t["level"] + 1, "begin")))
                .when(b.isin(")", "]", "}"), F.array(entry(t["level"] + 1, "end")))
                .when(b.isin("\n", ";"), F.array(entry(t["level"], "cut")))
                .otherwise(F.array().cast("array<struct<level:int,pos:int,kind:string,struct:boolean>>")))

    def step(s, t):
        piece = F.struct(F.lit(0).alias("link"), s["own"].alias("own"), s["cut"].alias("cut"), t["pos"].alias("end"),
                         t["level"].alias("level"))
        link = F.struct(t["pos"].alias("link"), s["own"].alias("own"), s["cut"].alias("cut"), F.lit(0).alias("end"),
                        t["level"].alias("level"))
        out = (F.when(s["struct"] & t["kind"].isin("cut", "end"), piece)
               .when(s["struct"] & (t["kind"] == "open") & t["struct"], link))
        begin = t["kind"] == "begin"
        return F.struct(F.when(begin, t["pos"]).otherwise(s["own"]).alias("own"),
                        F.when(begin, t["struct"]).otherwise(s["struct"]).alias("struct"),
                        F.when(t["kind"] == "open", s["cut"]).otherwise(t["pos"]).alias("cut")), out
    start = F.struct(F.lit(0).alias("own"), F.lit(False).alias("struct"), F.lit(0).alias("cut"))
    tokens = F.col("_marks")
    in_order = F.sort_array(F.flatten(F.transform(tokens, entries)))
    found = T.scan(in_order, start, step, "struct<link:int,own:int,cut:int,end:int,level:int>",
                   "struct<own:int,struct:boolean,cut:int>")
    return F.filter(found, lambda x: x.isNotNull())


def all_fields(st: DataFrame) -> DataFrame:
    """``(path, struct, struct_ord, owner, ord, name, type, tag)``: the fields of
    each struct and of the anonymous structs in it. ``owner`` is the dotted path
    of the fields around an inner field, null for the struct's own fields."""
    m, raw, shown = F.col("_mblock"), F.col("_cblock"), F.col("_rblock")

    def with_owner(found):
        links = F.map_from_entries(F.transform(F.filter(found, lambda x: x["link"] > 0), lambda x: F.struct(
            x["link"].alias("k"), F.struct(x["own"].alias("own"), x["cut"].alias("cut")).alias("v"))))

        def owners(ls):
            def up(acc, _):
                held = F.try_element_at(ls, acc["at"])
                names = F.transform(_names(F.substring(m, held["cut"] + 1, F.length(m))), lambda x: x["m"])
                longer = F.flatten(F.transform(names, lambda n: F.transform(acc["paths"], lambda p: F.when(
                    p == "", n).otherwise(F.concat(n, F.lit("."), p)))))
                return F.when(held.isNull(), acc).otherwise(F.struct(held["own"].alias("at"), longer.alias("paths")))

            def piece(x):
                first = F.struct(x["own"].alias("at"), F.array(F.lit("")).alias("paths"))
                paths = F.aggregate(F.sequence(F.lit(1), x["level"]), first, up, lambda acc: acc["paths"])
                return F.struct((x["cut"] + 1).alias("at"), (x["end"] - x["cut"] - 1).alias("n"),
                                F.when(x["own"] > 1, paths).otherwise(F.array(F.lit(""))).alias("owners"))
            return F.transform(F.filter(found, lambda x: x["link"] == 0), piece)
        return T.let(links, owners)

    def field(p):
        text = F.substring(m, p["at"], p["n"])
        head = F.length(F.regexp_extract(text, RX_FIELD, 0))
        # literals are blank in the masked text, so what is left behind the names is the type
        end = F.length(F.regexp_replace(text, r"(?U)(?<!\s)\s++$", ""))
        return F.struct(
            text.rlike(RX_FIELD).alias("ok"), p["owners"].alias("owners"), _names(text).alias("names"),
            F.substring(raw, p["at"] + head, end - head).alias("type"),
            T.search(F.substring(shown, p["at"] + end, p["n"] - end), RX_TAG, 1).alias("tag"))
    found = F.transform(T.let(_field_pieces(), with_owner), field)
    f = (st.withColumn("_marks", T.marks(m, r"\n;"))
         .select("path", F.col("name").alias("struct"), F.col("ord").alias("struct_ord"),
                 F.posexplode(found).alias("line", "f")).where("f.ok")
         .select("path", "struct", "struct_ord", "line", "f.names", "f.type", "f.tag", F.explode("f.owners").alias("owner"))
         .select("path", "struct", "struct_ord", "line", "type", "tag", "owner", F.posexplode("names").alias("i", "n")))
    return f.select("path", "struct", "struct_ord", F.nullif("owner", F.lit("")).alias("owner"),
                    (F.col("line").cast("long") * 1_000_000 + F.col("i")).alias("ord"), F.col("n.m").alias("name"), "type",
                    F.nullif(T.strip_chars("tag", "`\""), F.lit("")).alias("tag"))


def struct_fields(st: DataFrame) -> DataFrame:
    """``(path, struct, struct_ord, ord, name, type, tag)``, the struct's own
    fields; names sharing one type give one row each; embedded fields give none;
    an anonymous struct is the type of its field, as written; the tag keeps the
    analysed tool's ``strip('`"')`` (so ``json:"id"`` becomes ``json:"id``)."""
    return all_fields(st).where("owner is null").drop("owner")


# ------------------------------------------------------------------ G10
def imports(mf: DataFrame) -> DataFrame:
    """Top-level imports, single and grouped, in order: ``(path, ord, import_path)``."""
    return _import_rows(mf, _import_spans())


def _import_spans() -> Column:
    def specs(h):
        return F.when(h["m"].endswith("("), h["body"]).otherwise(h["m"])
    return F.transform(T.blocks("nocomment", RX_IMPORT, "(", ")"), specs)


def _import_rows(df: DataFrame, spans: Column) -> DataFrame:
    d = df.select("path", F.posexplode(spans).alias("d", "block"))
    return (d.select("path", "d", F.posexplode(T.findall("block", RX_IMPORT_PATH, 1)).alias("i", "import_path"))
            .select("path", (F.col("d").cast("long") * 1_000_000_000 + F.col("i")).alias("ord"), "import_path"))


# ------------------------------------------------------------------ G11
def consts(mf: DataFrame) -> DataFrame:
    """``(path, ord, name, type, value)``; names zipped with values by
    position, missing value NULL (no ``iota`` arithmetic), type only when a
    plain identifier is given. Values are parted by commas outside brackets."""
    return _consts_of(_specs(mf, "const"))


def _consts_of(specs: DataFrame) -> DataFrame:
    m, shown = F.col("masked"), F.col("nocomment")
    eq = F.locate("=", m)
    spec = (specs.where(m.rlike(RX_NAMES))
            .select("path", "pos", _names(m).alias("names"),
                    F.regexp_replace(F.when(eq > 0, F.substring(m, F.lit(1), eq - 1)).otherwise(m), RX_NAMES, "").alias("kind"),
                    F.when(eq > 0, F.substring(m, eq + 1, F.length(m))).alias("masked"),
                    F.when(eq > 0, F.substring(shown, eq + 1, F.length(shown))).alias("nocomment")))
    vals = F.transform(T.top_pieces(F.col("masked"), ","), lambda p: T.strip_ws(F.substring(F.col("nocomment"), p["pos"], p["n"])))
    spec = spec.withColumn("values", F.when(F.col("masked").isNotNull(), F.transform(
        F.filter(vals, lambda v: v != ""), lambda v: T.strip_chars(v, '"'))).otherwise(F.array().cast("array<string>")))
    kind = F.nullif(F.regexp_extract("kind", RX_CONST_TYPE, 1), F.lit(""))
    return (spec.select("path", "pos", kind.alias("type"), "values", F.posexplode("names").alias("i", "n"))
            .select("path", (F.col("pos") + F.col("n.pos")).cast("long").alias("ord"), F.col("n.m").alias("name"), "type",
                    F.try_element_at("values", F.col("i") + 1).alias("value")))


# ------------------------------------------------------------------ G12
def interfaces(mf: DataFrame) -> DataFrame:
    """``(path, interface, ord, method, signature)`` of top-level interfaces;
    embedded interfaces are not methods (SURVEY Q18: all method specs are reported)."""
    return _interfaces_of(_specs(mf, "type"))


def _interfaces_of(specs: DataFrame) -> DataFrame:
    block = F.col("m")
    found = (specs.select("path", "pos", "masked", "content", F.regexp_extract("masked", RX_INTERFACE, 2).alias("m"))
             .where(block != "")
             .select("path", "pos", F.regexp_extract("masked", RX_INTERFACE, 1).alias("interface"), "m",
                     F.substring("content", F.instr("masked", block), F.length(block)).alias("r")))
    m, raw = F.col("m"), F.col("r")

    def method(p):
        # one character in, behind the brace
        text = F.substring(m, p["pos"] + 1, p["n"])
        head = F.regexp_extract(text, RX_METHOD_SPEC, 0)
        name = F.regexp_extract(text, RX_METHOD_SPEC, 1)
        at = F.length(head)
        n = F.element_at(T.bracket_pairs(text, "(", ")"), at) - at + 1
        end = F.length(F.regexp_replace(text, r"(?U)(?<!\s)\s++$", ""))
        params = F.substring(raw, p["pos"] + at, n)
        result = T.strip_ws(F.substring(raw, p["pos"] + at + n, end - at - n + 1))
        return F.struct(name.alias("method"), T.strip_ws(F.concat(name, params, F.lit(" "), result)).alias("signature"),
                        (F.col("pos") + p["pos"]).alias("ord"))
    specs = F.filter(T.top_pieces(F.substring(m, F.lit(2), F.length(m) - 2), r"\n;"),
                     lambda p: F.substring(m, p["pos"] + 1, p["n"]).rlike(RX_METHOD_SPEC))
    return (found.select("path", "interface", F.explode(F.transform(specs, method)).alias("x"))
            .select("path", "interface", "x.ord", "x.method", "x.signature"))


# ------------------------------------------------------------------ G13
def file_documents(files: DataFrame) -> DataFrame:
    """One JSON document per file with imports, consts, interfaces,
    structs and functions (each function with its distinct call sets).

    A file is masked and searched once for all its parts. They are aggregated per
    file (one group per file, bounded by the file's own size) and joined on ``path``.
    """
    found = cut_lineage(masked_files(files).select(
        "path", _function_spans().alias("functions"), _struct_spans().alias("structs"), _import_spans().alias("imports"),
        _spec_spans("const", "type").alias("specs")), rebalance=False)
    fns, specs = _function_rows(found, F.col("functions")), _spec_rows(found, F.col("specs"))
    cl = calls(fns)
    sets = function_sets(cl)
    per_fn = (sets.groupBy("path", "function_ord")
              .agg(F.array_sort(F.collect_set(F.when(F.col("kind") == "call", F.col("value")))).alias("calls"),
                   F.array_sort(F.collect_set(F.when(F.col("kind") == "db", F.col("value")))).alias("db_access"),
                   F.array_sort(F.collect_set(F.when(F.col("kind") == "error", F.col("value")))).alias("error_messages"),
                   F.array_sort(F.collect_set(F.when(F.col("kind") == "router", F.col("value")))).alias("entry_points")))
    empty = F.array().cast("array<string>")
    fdoc = (fns.join(shuffled(per_fn.withColumnRenamed("function_ord", "ord")), ["path", "ord"], "left")
            .groupBy("path").agg(F.sort_array(F.collect_list(F.struct(
                "ord", "function_name", "signature",
                *[F.coalesce(F.col(c), empty).alias(c) for c in ("entry_points", "calls", "db_access", "error_messages")])))
                .alias("functions")))
    st = _struct_rows(found, F.col("structs"))
    fl = struct_fields(st)
    sdoc = (st.join(shuffled(fl.groupBy("path", "struct_ord").agg(F.sort_array(F.collect_list(
                F.struct("ord", "name", "type", "tag"))).alias("fields"))
                .withColumnRenamed("struct_ord", "ord")), ["path", "ord"], "left")
            .groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ord", "name", "fields", "body"))).alias("structs")))
    idoc = _import_rows(found, F.col("imports")).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ord", "import_path"))).alias("imports"))
    cdoc = _consts_of(specs.where("keyword = 'const'")).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ord", "name", "type", "value"))).alias("consts"))
    itf = _interfaces_of(specs.where("keyword = 'type'"))
    ifdoc = (itf.groupBy("path", "interface").agg(F.sort_array(F.collect_list(F.struct("ord", F.col("method").alias("name"), "signature"))).alias("methods"))
             .groupBy("path").agg(F.collect_list(F.struct(F.col("interface").alias("name"), "methods")).alias("interfaces")))
    doc = (found.select("path")
           .join(shuffled(idoc), "path", "left").join(shuffled(cdoc), "path", "left").join(shuffled(ifdoc), "path", "left")
           .join(shuffled(sdoc), "path", "left").join(shuffled(fdoc), "path", "left"))
    return doc.select(F.col("path").alias("file_path"),
                      F.to_json(F.struct(F.col("path").alias("file_path"),
                                         F.transform(F.coalesce("imports", F.array()), lambda x: x["import_path"]).alias("imports"),
                                         "consts", "interfaces", "structs", "functions")).alias("document"))
