"""Column functions over proof-language source and compiler output. All are native expressions; lengths and offsets count code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns of the source language and of compiler output ---------------------------------------------
WORD_CHAR = r"[\p{L}\p{N}_]"
#: What a pattern begins with is tried at every character, so that is a letter, not the look behind it.
HOLE = rf"(?=[sa])(?<!{WORD_CHAR})(?:sorry|admit)(?!{WORD_CHAR})"
ESCAPES = {
    "sorry": rf"(?=s)(?<!{WORD_CHAR})sorry(?!{WORD_CHAR})",
    "admit": rf"(?=a)(?<!{WORD_CHAR})admit(?!{WORD_CHAR})",
    "axiom": rf"(?md)^\s*+axiom(?!{WORD_CHAR})",
    "unsafe": rf"(?md)^\s*+unsafe(?!{WORD_CHAR})",
}
ERROR = rf"(?md)^.*(?<!{WORD_CHAR})error(?:\([^)]*\))?:"
PROOF_MARK = ":= by"
OUTPUT_TAIL = 30_000
#: All characters of (?U)\s.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# ----------------------------------------------------------------------------------------------------------------------

#: Block comments nested deeper than this go through the fold below.
DEPTH = 12


def _block(depth: int) -> str:
    body = r"/-(?:[^-/]++|(?!-/|/-)[-/]"
    return body + (")*+" if depth == 1 else "|" + _block(depth - 1) + ")*+") + r"(?:-/|\z)"


_TOKEN = r"--[^\n]*+|" + _block(DEPTH) + r'|"(?:[^"\\]++|\\(?s:.)|\\\z)*+(?:"|\z)|[^-/"]++|[-/]'


def let(value: Column, body) -> Column:
    """body(value), with value computed once, also where lambdas inside body use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mask_fold(source: Column) -> Column:
    """The same by a walk over the characters, for any depth; slower, so only where comments may nest deeply."""
    state = F.struct(F.lit("c").alias("mode"), F.lit(0).alias("depth"), F.lit(False).alias("skip"), F.lit("").alias("out"))

    def step(chars: Column):
        def one(a: Column, i: Column) -> Column:
            c, nxt = F.get(chars, i), F.coalesce(F.get(chars, i + 1), F.lit(""))
            pair = F.concat(c, nxt)
            blank = F.when(c == "\n", "\n").otherwise(" ")

            def to(mode, depth, skip, out):
                return F.struct(mode.alias("mode"), depth.alias("depth"), F.lit(skip).alias("skip"), F.concat(a["out"], out).alias("out"))

            mode, depth = a["mode"], a["depth"]
            return (
                F.when(a["skip"], to(mode, depth, False, F.lit("")))
                .when(mode == "l", to(F.when(c == "\n", "c").otherwise("l"), depth, False, blank))
                .when((mode == "b") & (pair == "/-"), to(mode, depth + 1, True, F.lit("  ")))
                .when((mode == "b") & (pair == "-/"), to(F.when(depth == 1, "c").otherwise("b"), depth - 1, True, F.lit("  ")))
                .when(mode == "b", to(mode, depth, False, blank))
                .when((mode == "s") & (c == "\\") & (nxt != ""), to(mode, depth, True, F.lit("  ")))
                .when(mode == "s", to(F.when(c == '"', "c").otherwise("s"), depth, False, F.when(c == '"', c).otherwise(blank)))
                .when(pair == "--", to(F.lit("l"), depth, True, F.lit("  ")))
                .when(pair == "/-", to(F.lit("b"), F.lit(1), True, F.lit("  ")))
                .otherwise(to(F.when(c == '"', "s").otherwise("c"), depth, False, c))
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), state, one, lambda a: a["out"])

    return let(F.regexp_extract_all(source, F.lit("(?s)."), F.lit(0)), lambda x: F.when(F.size(x) == 0, F.lit("")).otherwise(step(x)))


def _depth(source: Column) -> Column:
    """An upper bound of the depth of nested comments: marks in strings and line comments count as openings too, and a closing mark that an opening one follows at once doesn't."""
    marks = F.regexp_extract_all(source, F.lit("/-|-/(?!-)"), F.lit(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a: Column, m: Column) -> Column:
        now = F.when(m == "/-", a["now"] + 1).otherwise(F.greatest(a["now"] - 1, F.lit(0)))
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

    return F.aggregate(marks, start, step, lambda a: a["most"])


def mask_code(source: Column) -> Column:
    """Comments and string bodies blanked; newlines (but for one after a backslash in a string) and length stay."""

    def spaces(t: Column) -> Column:
        return F.array_join(F.transform(F.split(t, "\n", -1), lambda x: F.repeat(F.lit(" "), F.length(x))), "\n")

    def blank(t: Column) -> Column:
        in_string = F.regexp_replace(F.regexp_replace(t, r"(?s)\\.", "  "), r'[^\n"]', " ")
        return F.when(F.startswith(t, F.lit("--")) | F.startswith(t, F.lit("/-")), spaces(t)).when(F.startswith(t, F.lit('"')), in_string).otherwise(t)

    shallow = F.array_join(F.transform(F.regexp_extract_all(source, F.lit(_TOKEN), F.lit(0)), blank), "")
    deep = (F.regexp_count(source, F.lit("/-")) > DEPTH) & (_depth(source) > DEPTH)
    return F.when(deep, _mask_fold(source)).otherwise(shallow)


def count_holes(masked: Column) -> Column:
    return F.regexp_count(masked, F.lit(HOLE))


def matches(text: Column, pattern: str) -> Column:
    """Array of (offset, text) of the matches, in order; one walk over the pieces between them."""
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<offset:int,text:string>>)").alias("out"))

    def place(pieces: Column, found: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            at = a["at"] + F.length(x["piece"])
            one = F.struct(at.alias("offset"), x["found"].alias("text"))
            return F.struct((at + F.length(x["found"])).alias("at"), F.array_append(a["out"], one).alias("out"))

        both = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, f: F.struct(p.alias("piece"), f.alias("found")))
        return F.aggregate(both, empty, step, lambda a: a["out"])

    return let(text, lambda t: let(F.split(t, pattern, -1), lambda p: let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda f: place(p, f))))


def line_of(text: Column, offset: Column) -> Column:
    """Line number, from 1, of a code-point offset."""
    return F.size(F.split(F.substring(text, F.lit(1), offset), "\n"))


def escape_kinds(code: Column) -> Column:
    """The kinds of escape hatch in the text, in their fixed order."""
    return F.filter(F.array(*[F.when(F.contains(code, F.lit(k)) & F.regexp_like(code, F.lit(p)), F.lit(k)) for k, p in ESCAPES.items()]), lambda k: k.isNotNull())


def baseline_success(exit_code: Column, before: Column, after: Column) -> Column:
    """Exit 0, the statement unchanged, and no escape hatch in the raw text, comments and strings included."""
    return F.coalesce((exit_code == 0) & (statement_prefix(before) == substring_prefix(after)) & (F.size(escape_kinds(after)) == 0), F.lit(False))


def verified(exit_code: Column, forbidden: Column, holes: Column, reject_holes: Column) -> Column:
    """Exit 0 and, where holes are rejected, no holes and no forbidden kinds."""
    return F.coalesce((exit_code == 0) & (~reject_holes | ((holes == 0) & (F.size(forbidden) == 0))), F.lit(False))


def tail(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def count_errors(output: Column, last: int = OUTPUT_TAIL) -> Column:
    return F.regexp_count(tail(output, last), F.lit(ERROR))


def statement_prefix(source: Column) -> Column:
    """The text to the first proof mark, with it; an error if there is none."""
    return F.when(F.contains(source, F.lit(PROOF_MARK)), F.concat(F.substring_index(source, PROOF_MARK, 1), F.lit(PROOF_MARK))).otherwise(F.raise_error(F.lit("no ':= by' boundary")))


def substring_prefix(source: Column) -> Column:
    """As statement_prefix, but null where there is no proof mark."""
    return F.when(F.contains(source, F.lit(PROOF_MARK)), F.concat(F.substring_index(source, PROOF_MARK, 1), F.lit(PROOF_MARK)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def unfence(text: Column) -> Column:
    """Model output without the code fence around it."""
    inner = lambda bare: F.regexp_replace(F.regexp_replace(bare, r"(?s)^[^\n]*\n", ""), r"(?s)```(?!.*```).*\z", "")
    return let(strip(text), lambda bare: F.when(F.startswith(bare, F.lit("```")), inner(bare)).otherwise(bare))


def json_object(text: Column) -> Column:
    """The unfenced text if it is a JSON object, else null."""
    return let(unfence(text), lambda body: F.when(_is_object(body), body))


def _is_object(body: Column) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(body))
    return F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))


def dedent(text: Column) -> Column:
    """The common indent of the lines with text removed, blank lines emptied. Indents that mix tabs and spaces share their common prefix."""

    def cut(lines: Column) -> Column:
        filled = F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"[^ \t\n\x0b\f\r]")))
        indents = F.transform(filled, lambda x: F.regexp_extract(x, r"^[ \t]*", 0))
        lo, hi = F.array_min(indents), F.array_max(indents)
        n = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), F.length(lo)), lambda k: F.substring(lo, F.lit(1), k) == F.substring(hi, F.lit(1), k))), F.lit(0))
        return let(n, lambda k: F.array_join(F.transform(lines, lambda x: F.when(F.regexp_like(x, F.lit(r"[^ \t\n\x0b\f\r]")), F.substring(x, k + 1, F.length(x))).otherwise("")), "\n"))

    return let(F.split(text, "\n"), cut)


def install_proof(source: Column, proof: Column) -> Column:
    """The frozen statement with the proof under it: dedented, without an outer `by`, indented by two."""
    body = strip(dedent(proof))
    inner = dedent(F.regexp_replace(F.substring(body, F.lit(3), F.length(body)), r"^\n+", ""))
    body = F.when(F.startswith(body, F.lit("by\n")) | (body == "by"), inner).otherwise(body)
    lines = F.split(F.regexp_replace(body, r"\n\z", ""), "\n")
    indented = F.array_join(F.transform(lines, lambda x: F.when(x == "", x).otherwise(F.concat(F.lit("  "), x))), "\n")
    return F.concat(statement_prefix(source), F.lit("\n"), indented, F.lit("\n"))


def normal_content(content: Column) -> Column:
    return F.concat(F.rtrim(content, F.lit(BLANKS)), F.lit("\n"))


def safe_path(path: Column) -> Column:
    """Relative, without a parent step, a source file."""
    return ~F.startswith(path, F.lit("/")) & ~F.array_contains(F.split(path, "/"), "..") & F.regexp_like(path, F.lit(r"(?:^|/)[^/]+\.lean\z"))


def inside(path: Column) -> Column:
    """Whether a tool may read the path below its root: relative, and no step above it."""
    depth = F.aggregate(F.split(path, "/"), F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), _walk, lambda a: a["least"])
    return ~F.startswith(path, F.lit("/")) & (depth >= 0)


def _walk(a: Column, step: Column) -> Column:
    at = F.when(step == "..", a["at"] - 1).when(step.isin("", "."), a["at"]).otherwise(a["at"] + 1)
    return F.struct(at.alias("at"), F.least(a["least"], at).alias("least"))


def module_name(path: Column) -> Column:
    """A source path as a dotted module name, parts that aren't identifiers quoted."""
    parts = F.split(F.regexp_replace(path, r"\.lean\z", ""), "/")
    return F.array_join(F.transform(parts, lambda p: F.when(F.regexp_like(p, F.lit(r"^[\p{L}_][\p{L}\p{N}_]*\z")), p).otherwise(F.concat(F.lit("«"), p, F.lit("»")))), ".")


def line_count(text: Column) -> Column:
    """Lines by all line ends, no empty one at the end."""
    ends = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85  ]"
    open_end = F.when((F.length(text) > 0) & ~F.regexp_like(F.right(text, F.lit(1)), F.lit(ends)), 1).otherwise(0)
    return F.regexp_count(text, F.lit(ends)) + open_end


def trace_goal(source: Column, line: Column) -> Column:
    """`trace_state` above the line (clamped) if its code holds a hole, with its indent; else null."""

    def put(lines: Column) -> Column:
        k = F.greatest(F.lit(0), F.least(line - 1, F.size(lines) - 1))
        own = F.get(lines, k)
        more = F.concat(F.regexp_extract(own, r"(?U)^\s*", 0), F.lit("trace_state"))
        out = F.concat(F.slice(lines, 1, k), F.array(more), F.slice(lines, k + 1, F.size(lines)))
        return F.when(count_holes(mask_code(own)) > 0, F.concat(F.array_join(out, "\n"), F.lit("\n")))

    return let(F.split(F.regexp_replace(source, r"\n\z", ""), "\n"), put)


def read_range(source: Column, start: Column, end: Column, most: int = 400) -> Column:
    """Lines start to end, at most `most` past start, numbered."""
    first, last = F.greatest(F.lit(1), start), F.least(end, start + most)
    lines = F.split(F.regexp_replace(source, r"\n\z", ""), "\n")
    numbered = F.transform(lines, lambda x, i: F.struct((i + 1).alias("i"), F.concat((i + 1).cast("string"), F.lit(": "), x).alias("t")))
    return F.array_join(F.transform(F.filter(numbered, lambda x: (x["i"] >= first) & (x["i"] <= last)), lambda x: x["t"]), "\n")


def around(source: Column, offset: Column, reach: int = 1500) -> Column:
    lo = F.greatest(offset - reach, F.lit(0))
    return F.substring(source, lo + 1, offset + reach - lo)
