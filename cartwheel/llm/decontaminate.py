"""Benchmark decontamination by template canonicalisation, in DataFrame operations.

Numbers, names and units become typed placeholders, so a question asked again with other values has the
same template. Templates are cut into windows; the windows of the benchmark are hash-joined with all
windows of all documents. A hit also needs consistent slots: the pattern in which slot values recur in the window (first,
second, first again ...) must be equal on both sides, as a re-parameterised question replaces equal values by equal
ones. Windows that consist mostly of slots say little and are not used as templates.

A capitalised word that begins a sentence may be a name or not: templates are compared once with such words as literals and
once with every run of capitalised words as one name, on both sides.

Whole items must be findable whatever their words are, so a second join compares the tokens themselves, without types or a
bound on literals: every window of the benchmark, and every shorter item as a whole, is found where it stands word for word.

Making the tokens of a reading takes many passes over a text, so texts are sieved first, in one pass: a window that is hit has its longest
pair of neighbouring words (or its longest word, if it has no such pair) in the text, in all readings. Texts with none of these
keys have no hit and no reading is made of them. Texts in which readings cut words differently always pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch

WINDOW = 13
MIN_LITERALS = 8
BROADCAST_WINDOWS = 1_000_000  # benchmark windows (16 bytes each) that are sent to all tasks; more are shuffled

# Units that follow a number.
UNITS = ("km", "cm", "mm", "nm", "m", "mi", "miles", "ft", "feet", "in", "inch", "inches", "yd", "yards", "kg", "mg", "g", "lb", "lbs", "oz", "l", "ml", "s", "sec", "seconds",
         "min", "minutes", "h", "hr", "hours", "days", "weeks", "months", "years", "usd", "eur", "dollars", "euros", "cents", "percent", "degrees", "kwh", "kw", "w", "v", "hz")
NAME, NUMBER, UNIT = "\x02", "\x03", "\x04"
_UNIT = "|".join(sorted(UNITS, key=len, reverse=True))
_LETTER = r"[\p{L}\p{N},;)'\x22-][ ]"  # what stands before a name; a capital letter at the beginning of a sentence is none
#: (pattern, replacement) in order; groups are written $1. The steps of NUMBERS change nothing in a text without digits.
CONTROLS = (r"[\x01-\x08]", " ")
NUMBERS = (
    (r"(\d)(" + _UNIT + r")([^\p{L}\p{N}]|$)", "$1 $2$3"),
    (r"(^|[^\p{L}\p{N}.,])([+-]?\d+([.,:/]\d+)*)", "$1 " + NUMBER + "$2"),
    (r"(\d[%.]?[ ])(" + _UNIT + r")([^\p{L}\p{N}]|$)", "$1" + UNIT + "$2$3"),
)
NAMES = (r"\p{Lu}(?<=" + _LETTER + r"\p{Lu})\p{Ll}+", NAME + "$0")
#: The same without looking behind: a second pass finds the second of two names in a row.
NAMES_TWICE = ((r"(" + _LETTER + r")(\p{Lu}\p{Ll}+)", "$1" + NAME + "$2"),) * 2
PUNCTUATION = (r"[^a-zA-Z0-9\x20\x09-\x0D\x02-\x04\p{L}\p{N}]+", "")
TEMPLATE = (r"([\x02-\x04])[^\x20\x09-\x0D]+", "$1")
SPLIT = r"[\x20\x09-\x0D]+"


def canonical(text: Column) -> Column:
    """Lower-cased tokens joined by one space; numbers, names and units carry a mark of their type in front."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), *CONTROLS)
    out = plain
    for pattern, to in NUMBERS:
        out = F.regexp_replace(out, pattern, to)
    out = F.when(plain.rlike("[0-9]"), out).otherwise(plain)
    out = F.regexp_replace(F.regexp_replace(out, *NAMES), *PUNCTUATION)
    return F.trim(F.regexp_replace(F.lower(out), SPLIT, " "))


#: Any capitalised word is a name, wherever it stands, and a run of them is one.
ANY_NAME = (r"\p{Lu}(?<![\p{L}\p{N}\p{M}]['’-]?\p{Lu})[\p{L}\p{M}\p{N}'’-]*", " " + NAME + "$0")
RUN_OF_NAMES = (r"(\x02[\p{L}\p{M}\p{N}'’-]*)\x20+(?=\x02)", "$1")


def folded(text: Column) -> Column:
    """As ``canonical``, but white space is made one first and names may begin a sentence or line, be in capitals or have several words."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x01-\x20]+", " ")
    out = plain
    for pattern, to in NUMBERS:
        out = F.regexp_replace(out, pattern, to)
    out = F.when(plain.rlike("[0-9]"), out).otherwise(plain)
    for pattern, to in (ANY_NAME, RUN_OF_NAMES, PUNCTUATION):
        out = F.regexp_replace(out, pattern, to)
    return F.trim(F.regexp_replace(F.lower(out), SPLIT, " "))


#: Scripts written without spaces (Thai, Lao, Tibetan, Burmese, Khmer, kana, Han): each character is a token where tokens are compared as they are.
UNSPACED = (r"[\u0E00-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]\p{M}*", " $0 ")
#: Between digits an operator is a token and a separator stays; all else that is no letter, digit or mark goes. What is rare in a text is tried first.
OPERATORS = (r"\x20?([-+*/=<>^×÷])(?<=\d\x20?[-+*/=<>^×÷])\x20?(?=\d)", " $1 ")
SYMBOLS = (r"[^a-z0-9\x20\x09-\x0D\p{L}\p{N}\p{M}](?<!\d[.,:](?=\d)|\d\x20[-+*/=<>^×÷](?=\x20\d))", "")


def exact(text: Column) -> Column:
    """Lower-cased tokens joined by one space, numbers and names with their values and without marks."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in (UNSPACED, OPERATORS, SYMBOLS, (SPLIT, " ")):
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


#: Words that a reading may cut where white space does not: letters and digits in one word, a capital behind a sign inside a word,
#: control characters, and scripts without spaces.
ODD = (r"\p{L}[^\p{L}\d\s]*+\d|\d[^\p{L}\d\s]*+\p{L}|[\p{L}\p{N}][^\s\p{L}\p{N}]++\p{Lu}|[\x01-\x08\x0E-\x1F]|"
       r"[\u0E00-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]")
WORD = r"^\p{L}+$"
MAX_KEYS = 100_000  # keys that are tested inside the scan; more are joined. The result is the same.


def sieve_keys(benchmark: DataFrame, width: int) -> DataFrame:
    """key, kind (2: pair of neighbouring words, 1: a word, 0: a window without any word) of every window in every reading."""
    out = None
    for reading in (canonical, folded, exact):
        t = benchmark.select(reading(F.col("text")).alias("c")).where("c <> ''").distinct().select(F.split("c", " ").alias("t"))
        t = t.withColumn("i", F.explode(F.expr(f"sequence(1, greatest(1, size(t) - {width - 1}))"))).select(F.slice("t", F.col("i"), F.lit(width)).alias("t"))
        words = F.transform("t", lambda x: F.struct(F.when(x.rlike(WORD), F.length(x)).alias("n"), F.xxhash64(x).alias("h")))
        pairs = F.expr("filter(transform(sequence(0, size(w) - 1), i -> struct(get(w, i).n + get(w, i + 1).n AS n, xxhash64(get(w, i).h, get(w, i + 1).h) AS h)), p -> p.n IS NOT NULL)")
        t = t.select(words.alias("w")).select(F.array_max(pairs)["h"].alias("pair"), F.array_max(F.filter("w", lambda x: x["n"].isNotNull()))["h"].alias("word"))
        t = t.select(F.coalesce("pair", "word", F.lit(0)).alias("key"), F.when(F.col("pair").isNotNull(), 2).when(F.col("word").isNotNull(), 1).otherwise(0).alias("kind"))
        out = t if out is None else out.unionByName(t)
    return scratch(out.distinct(), "sieve")


def sieved(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """Stored doc_id and text of the rows that may hold a window of the benchmark."""
    rows = docs.select("doc_id", "text")
    keys = sieve_keys(benchmark, width)
    if not keys.where("kind = 0").isEmpty():
        return rows  # such a window may stand in any text
    n = keys.count()
    plain = F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[^a-zA-Z0-9\x20\x09-\x0D\p{L}\p{N}]+", "")), SPLIT, " "))
    hashes = F.transform(F.split(plain, " "), lambda w: F.xxhash64(w))
    kinds = {r["kind"] for r in keys.select("kind").distinct().collect()}
    if n <= MAX_KEYS:
        known = {kind: [r["key"] for r in keys.where(F.col("kind") == kind).collect()] for kind in kinds}
        places = F.expr("sequence(1, greatest(1, size(h) - 1))")
        hit = F.lit(False)
        if 2 in kinds:
            hit = hit | F.exists(places, lambda i: F.xxhash64(F.get("h", i - 1), F.get("h", i)).isin(known[2]))
        if 1 in kinds:
            hit = hit | F.exists("h", lambda x: x.isin(known[1]))
        # an array as a generated column keeps the hashes from being computed for each of its uses
        found = rows.withColumn("h", F.explode(F.array(F.when(F.col("text").rlike(ODD), F.lit(None)).otherwise(hashes)))).where(F.col("h").isNull() | hit)
        return scratch(found.select("doc_id", "text"), "sieved")
    both = F.concat(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("h") - 1)), lambda i: F.struct(F.xxhash64(F.get("h", i - 1), F.get("h", i)).alias("key"), F.lit(2).alias("kind"))),
                    F.transform("h", lambda x: F.struct(x.alias("key"), F.lit(1).alias("kind"))))
    odd = rows.where(F.col("text").rlike(ODD)).select("doc_id")
    found = rows.select("doc_id", hashes.alias("h")).select("doc_id", F.explode(F.array_distinct(both)).alias("k")).select("doc_id", "k.*").join(keys, ["key", "kind"], "left_semi").select("doc_id")
    ids = found.unionByName(odd).distinct().withColumnRenamed("doc_id", "_id")
    return scratch(rows.join(ids, rows["doc_id"].eqNullSafe(ids["_id"]), "left_semi"), "sieved")


def is_template(literals: Column, n: Column, width: int, least: int) -> Column:
    """Whether ``n`` tokens with so many literal ones are used as a template: ``least`` of them, or, in an item shorter than a window,
    three and half of all, beside two slots (with one slot only, another value is as a rule another question)."""
    return (literals >= least) | ((n < width) & (literals >= 3) & (2 * literals >= n) & (n - literals >= 2))


BEGIN = 3  # tokens whose hash tells quickly that no benchmark window begins at a place
#: Distinct beginnings and longest tokens of benchmark windows that texts are searched for first; with more of
#: them every window goes to the join. The result is the same.
MAX_BEGINNINGS, MAX_ANCHORS = 100_000, 10_000


def windows(table: DataFrame, key: str, widths: list[int], whole_below: bool = False, beginnings: list[int] | None = None, anchors: list[int] | None = None, reading=canonical) -> DataFrame:
    """id, width, begin, anchor, literals, template, pattern of all windows of each width in each text.

    template: hash of the typed tokens, begin: of the first of them, anchor: of the longest; pattern: hash of where each slot
    value occurs first in the window (0: no slot). ``whole_below``: a text of fewer tokens gives one window, itself.
    ``beginnings``: only windows that begin so; ``anchors``: only texts with one of these tokens (the anchor is then left out).
    ``reading``: what makes tokens of a text; a text without any has no window."""
    # no filter stands on computed columns here: the optimiser would move it down and compute them once more for it
    tokens = table.select(F.col(key).alias("id"), reading(F.col("text")).alias("c"))
    marked = F.col("c").rlike("[\\x02-\\x04]")
    shape = F.transform(F.split(F.when(marked, F.regexp_replace("c", *TEMPLATE)).otherwise(F.col("c")), " "), lambda w: F.xxhash64(w))
    value = F.expr("transform(split(c, ' '), w -> if(ascii(w) < 5, shiftrightunsigned(xxhash64(w), 1) | 1, 0L))")
    length = F.array().cast("array<int>") if anchors is not None else F.transform(F.split("c", " "), F.length)
    shape = F.when(F.col("c") != "", shape).otherwise(F.array().cast("array<bigint>"))
    tokens = tokens.select("id", shape.alias("t"), F.when(marked, value).alias("v"), length.alias("l"))
    out = None
    for width in widths:
        begin = "xxhash64(" + ", ".join(f"get(t, i{k - 1:+d})" for k in range(min(BEGIN, width))) + ")"
        cut = f"transform(at, i -> struct({begin} AS begin, slice(t, i, width) AS t, slice(v, i, width) AS v, slice(l, i, width) AS l))"
        w = tokens.withColumn("width", F.least(F.size("t"), F.lit(width)) if whole_below else F.lit(width))
        places = F.expr("if(size(t) >= width AND width > 0, sequence(1, size(t) - width + 1), cast(array() as array<int>))")
        if beginnings is not None:
            places = F.filter(places, lambda i: F.xxhash64(*(F.get("t", i + (k - 1)) for k in range(min(BEGIN, width)))).isin(beginnings))
        if anchors is not None:
            places = F.when(F.arrays_overlap("t", F.array(*(F.lit(x) for x in anchors))), places)
        w = w.withColumn("at", places).select("id", "width", F.explode_outer(F.expr(cut)).alias("w")).where("w IS NOT NULL").select("id", "width", "w.*")
        longest = F.array_max(F.arrays_zip("l", "t"))["t"].alias("anchor")
        slots = "if(v IS NULL OR array_max(v) = 0, 0L, xxhash64(transform(v, x -> if(x = 0, 0L, array_position(v, x)))))"
        literals = "if(v IS NULL, size(t), size(filter(v, x -> x = 0)))"
        w = w.select("id", "width", "begin", longest, F.expr(literals).alias("literals"), F.xxhash64("t").alias("template"), F.expr(slots).alias("pattern"))
        out = w if out is None else out.unionByName(w)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, min_literals: int = MIN_LITERALS) -> DataFrame:
    """Find the documents that hold a window of a benchmark item, slots changed consistently or not at all.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. A benchmark text of fewer than ``width`` tokens is one
    window. Windows with fewer than ``min_literals`` literal tokens are not used as templates (shorter items: see ``is_template``); they are found, like all others, where their very tokens stand. Texts of any length are read whole. Result, one row per row of ``docs``: doc_id, contaminated, n_hits (windows hit as
    templates; if none is, as templates with every capitalised word a name; if none is, token by token), item_id (least item hit in the join that n_hits counts, else -1).
    Null and empty texts are clean, items without a letter or digit match nothing; rows that repeat a doc_id share the findings
    of all of them, as rows without an id do. An empty benchmark leaves all documents clean. Other columns are ignored."""
    ids, hits = docs.select("doc_id"), None
    docs = sieved(docs, benchmark, width)
    for rank, (reading, least) in enumerate(((canonical, min_literals), (folded, min_literals), (exact, 0))):
        part = _hits(docs, benchmark, width, least, reading)
        if part is not None:
            part = part.withColumn("rank", F.lit(rank))
            hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return ids.select("doc_id", F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_hits"), F.lit(-1).cast("long").alias("item_id"))
    found = hits.groupBy("id", "rank").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("item"))
    found = found.groupBy("id").agg(F.min(F.struct("rank", "n", "item")).alias("x")).select("id", F.col("x.n").alias("n_hits"), F.col("x.item").alias("item_id"))
    out = ids.join(found, ids["doc_id"].eqNullSafe(found["id"]), "left")
    return out.select("doc_id", F.col("n_hits").isNotNull().alias("contaminated"), F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"), F.coalesce("item_id", F.lit(-1)).cast("long").alias("item_id"))


def _hits(docs: DataFrame, benchmark: DataFrame, width: int, min_literals: int, reading) -> DataFrame | None:
    """id, item_id of each window of the documents that is a window of the benchmark in this reading; None without benchmark windows."""
    asked = windows(benchmark, "item_id", [width], True, reading=reading).where(is_template(F.col("literals"), F.col("width"), width, min_literals))
    asked = scratch(asked.groupBy("width", "begin", "template", "pattern").agg(F.min("id").alias("item_id"), F.first("anchor").alias("anchor")), "asked")
    n, widths = asked.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("width"))).first()  # at most ``width`` values
    if not n:
        return None
    first = [r["begin"] for r in asked.select("begin").distinct().limit(MAX_BEGINNINGS + 1).collect()]
    words = [r["anchor"] for r in asked.select("anchor").distinct().limit(MAX_ANCHORS + 1).collect()]
    side = (F.broadcast(asked) if n <= BROADCAST_WINDOWS else asked).drop("begin", "anchor")
    found = windows(docs, "doc_id", list(widths), beginnings=first if len(first) <= MAX_BEGINNINGS else None, anchors=words if len(words) <= MAX_ANCHORS else None, reading=reading)
    return found.select("id", "width", "template", "pattern").join(side, ["width", "template", "pattern"]).select("id", "item_id")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All columns of the documents that are not contaminated."""
    bad = decontaminate(docs, benchmark, **options).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")


def sql_canonical() -> str:
    """The same steps as SQL over a column ``text``, for engines that write groups as \\1."""
    out = "coalesce(text, '')"
    for pattern, to in (CONTROLS, *NUMBERS, *NAMES_TWICE, PUNCTUATION):
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(to.replace('$', chr(92)))}, 'g')"
    return f"trim(regexp_replace(lower({out}), {_quoted(SPLIT)}, ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
