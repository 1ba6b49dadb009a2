"""Secrets in texts, with DataFrame functions only.

Base patterns are found by the JVM's regular expressions; a match's place is the sum of the lengths of what was split off
and matched before it. On top, long strings of one character class are judged by the Shannon entropy of a sliding
window. Its counts are incremental: when a character enters or leaves, only its own term c * log2(c) changes, by an
amount that its count in the window gives. Sums are of scaled integers, so they are exact. In strings shaped like a path
a window must also change between small letters, capitals and digits as often as random characters do, which words do not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import materialize

# Fixed values of the contract: patterns and least lengths
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_mixed"]

# The method's own settings
CANDIDATE = r"[A-Za-z0-9+/_=-]+"
WIDTH = 20
MIN_BITS = {"entropy_hex": 3.0, "entropy_mixed": 3.7}  # a character, in some window
MIN_TURNS = 7  # of a window in what is shaped like a path
SCALE = 1 << 20
PATTERNS = [ASSIGN, ACCESS[:-1] + f"{{{LEAST['access'] - 4},}}", HEX[:-1] + f"{{{LEAST['hex']},}}", CANDIDATE[:-1] + f"{{{WIDTH},}}"]
# Allow-list: what looks random but is no secret
NEVER = "|".join([
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9+/_=-]+$",  # numbers, dates
    r"^(.{1,4})\1{4,}.{0,3}$",  # nothing but one short string again and again
])
WORDS = {"example": 7, "sample": 6, "placeholder": 11, "dummy": 5, "x{6}": 6, "0123456789": 10, "abcdefghij": 10}  # no window may hold one; with lengths
PATH = r"(/[A-Za-z0-9_.-]*){3}"  # shaped like a path; random base64 can be, too, so only its windows decide
ALLOWED_BEFORE = r"(?i)(sha-?(1|224|256|384|512)|md5|integrity|digest|checksum|commit)\W{0,3}$"


def _items(text: Column, kind: str, pattern: str, group: int, keep, extra) -> Column:
    """For each match: length of the text before it (since the match before), its own length, and whether it counts."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    before = F.split(text, pattern, -1)
    rows = F.arrays_zip(before.alias("before"), found.alias("found"), value.alias("value"))

    def one(x: Column, i: Column) -> Column:
        kept = keep(x)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["before"]).alias("skip"), F.length(x["found"]).alias("length"),
            kept.alias("kept"), *[F.when(kept & F.lit(extra), v).alias(n) for n, v in (
                ("value", x["value"]), ("hexadecimal", x["value"].rlike("^[0-9a-fA-F]+$")), ("path", x["value"].rlike(PATH)))])

    items = F.transform(F.filter(rows, lambda x: x["found"].isNotNull()), one)
    none = F.array().cast("array<struct<kind:string,i:int,skip:int,length:int,kept:boolean,value:string,hexadecimal:boolean,path:boolean>>")
    return F.when(text.rlike(pattern), items).otherwise(none)  # one look decides whether the text is taken apart


def _candidate(x: Column) -> Column:
    long = F.length(x["found"]) >= WIDTH
    letters = x["found"].rlike("[A-Za-z]") & x["found"].rlike("[0-9]")
    return long & letters & ~x["found"].rlike(NEVER) & ~x["before"].rlike(ALLOWED_BEFORE)


def _term(c: Column) -> Column:
    """c * log2(c), scaled, from a table that ends at the window's width."""
    table = [0] + [round(n * math.log2(n) * SCALE) for n in range(1, WIDTH + 1)]
    return F.array(*[F.lit(t).cast("long") for t in table])[c.cast("int")]


def _turn(c: Column, before: Column) -> Column:
    """1 where a run of small letters, capitals or digits begins; a capital and small letters after it are one run."""
    kind = lambda x: F.when(x.between("a", "z"), 1).when(x.between("A", "Z"), 2).when(x.between("0", "9"), 3).otherwise(0)
    return ((kind(c) > 0) & (kind(c) != kind(before)) & ~((kind(c) == 1) & (kind(before) == 2))).cast("int")


def _entropy_spans(candidates: DataFrame) -> DataFrame:
    """Rows (row id, kind, start, end) for stored candidates (row id, start, value, hexadecimal, path) with a window of high entropy.

    The span goes from the first such window to the end of the last. A window must not touch an allow-listed word; windows of a
    path must have ``MIN_TURNS``, too. What looks at a whole value is stored with it: beside an explode it would run for each character.
    """
    kind = F.when(F.col("hexadecimal"), "entropy_hex").otherwise("entropy_mixed")
    masked = F.col("value")
    for word, length in WORDS.items():
        masked = F.regexp_replace(masked, f"(?i){word}", " " * length)
    each = F.arrays_zip(F.split("value", "").alias("c"), F.split(F.concat(F.lit(" "), "value"), "").alias("before"), F.split(masked, "").alias("shown"))
    chars = candidates.select("key", "digest", "start", kind.alias("kind"), "path", F.posexplode(each).alias("p", "x"))
    allowed = (F.col("x.shown") == " ").cast("int")
    chars = chars.select("*", "x.c", _turn(F.col("x.c"), F.col("x.before")).alias("turn"), allowed.alias("allowed")).where("c <> ''")
    one = ["key", "digest", "start", "kind", "path"]
    same = Window.partitionBy(*one, "c").orderBy("p")
    entering = F.count("*").over(same.rangeBetween(-(WIDTH - 1), 0))
    leaving = F.count("*").over(same.rangeBetween(0, WIDTH - 1))
    steps = chars.select(*one, "p", "turn", "allowed", (_term(entering) - _term(entering - 1)).alias("up"), (_term(leaving) - _term(leaving - 1)).alias("down"))
    along = Window.partitionBy(*one).orderBy("p")
    up = F.sum("up").over(along.rowsBetween(Window.unboundedPreceding, 0))
    down = F.coalesce(F.sum("down").over(along.rowsBetween(Window.unboundedPreceding, -WIDTH)), F.lit(0))
    turns = F.sum("turn").over(along.rowsBetween(-(WIDTH - 1), 0))
    words = F.sum("allowed").over(along.rowsBetween(-(WIDTH - 1), 0))
    sums = steps.select(*one, "p", (up - down).alias("s"), turns.alias("turns"), words.alias("words")).where((F.col("p") >= WIDTH - 1) & (F.col("words") == 0))
    most = {k: round(WIDTH * (math.log2(WIDTH) - bits) * SCALE) for k, bits in MIN_BITS.items()}
    limit = F.when(F.col("kind") == "entropy_hex", F.lit(most["entropy_hex"])).otherwise(F.lit(most["entropy_mixed"]))
    spans = sums.where((F.col("s") <= limit) & (~F.col("path") | (F.col("turns") >= MIN_TURNS))).groupBy(*one).agg(F.min("p").alias("a"), F.max("p").alias("b"))
    return spans.select("key", "digest", "kind", (F.col("start") + F.col("a") - (WIDTH - 1)).alias("start"), (F.col("start") + F.col("b") + 1).alias("end"))


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds a name for the row's content: equal rows have equal secrets."""
    return docs.withColumns({"_secret_key": F.col(key).cast("string"), "_secret_digest": F.xxhash64(text)})


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, digest, spans) for the distinct rows of ``docs`` that hold secrets.

    ``key`` is the row's key as text, ``digest`` the hash of its text, ``spans`` an array of (start, place of the kind,
    kind, end), sorted; places are code points, the end is exclusive. Null and empty texts hold none.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    least = lambda n: lambda x: F.length(x["value"]) >= n
    items = F.concat(
        _items(t, "assign", ASSIGN, 2, least(LEAST["assign"]), False),
        # a run is found whole, so asking for its least length in the pattern drops the same matches
        _items(t, "access", PATTERNS[1], 0, lambda x: F.lit(True), False),
        _items(t, "hex", PATTERNS[2], 0, lambda x: F.lit(True), False),
        _items(t, "candidate", PATTERNS[3], 0, _candidate, True),
    )
    rows = _named(docs.select(key, text), key, text)
    rows = rows.select(F.col("_secret_key").alias("key"), F.col("_secret_digest").alias("digest"), F.inline(items))
    rows = materialize(rows.distinct(), "secret-items")
    along = Window.partitionBy("key", "digest", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("skip") + F.col("length")).over(along)
    placed = rows.select("key", "digest", "kind", (end - F.col("length")).alias("start"), end.alias("end"), "kept", "value", "hexadecimal", "path").where("kept")
    base = placed.where("kind <> 'candidate'").select("key", "digest", "kind", "start", "end")
    found = base.unionByName(_entropy_spans(placed.where("kind = 'candidate'").select("key", "digest", "start", "value", "hexadecimal", "path")))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(F.col("start").cast("long").alias("start"), number.cast("int").alias("place"), "kind", F.col("end").cast("long").alias("end"))
    return found.groupBy("key", "digest").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, spans), one for each row of ``docs``, in the form of ``scan``; an empty array where there are none.

    Repeated rows each get their spans, rows with a null key too. Other columns are left aside. An empty table gives
    an empty table.
    """
    found = scan(docs, key, text)
    rows = _named(docs.select(key, text), key, text).select(key, "_secret_key", "_secret_digest")
    same = F.col("_secret_key").eqNullSafe(F.col("key_found")) & (F.col("_secret_digest") == F.col("digest"))
    joined = rows.join(found.withColumnRenamed("key", "key_found"), same, "left")
    empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    return joined.select(F.col(key), F.coalesce("spans", empty).alias("spans"))


def shown(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def is_base(span: Column) -> Column:
    return span["place"] <= len(LEAST)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[secret]", length: str | None = None) -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; overlapping spans become one mark. All rows and columns stay.

    ``length`` names a column that is set to the new number of code points where the text has changed.
    """
    found = scan(docs, key, text).withColumnRenamed("key", "_secret_key_found").withColumnRenamed("digest", "_secret_digest_found")
    found = found.withColumnRenamed("spans", "_secret_spans")
    same = F.col("_secret_key").eqNullSafe(F.col("_secret_key_found")) & (F.col("_secret_digest") == F.col("_secret_digest_found"))
    # only texts that some pattern matches are shuffled to their spans; the others go straight through
    maybe = F.coalesce(F.col(text).rlike("|".join(PATTERNS)), F.lit(False))
    joined = _named(docs.where(maybe), key, text).join(found, same, "left")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        grown = F.when(s["start"] >= acc["at"], F.concat(acc["done"], gap, F.lit(mark))).otherwise(acc["done"])
        return F.struct(grown.alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    rest = lambda acc: F.concat(acc["done"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(text)))
    cleaned = F.when(F.col("_secret_spans").isNull(), F.col(text)).otherwise(F.aggregate("_secret_spans", start, step, rest))
    out = joined.withColumn("_secret_text", cleaned)
    columns = {text: F.col("_secret_text")}
    if length:
        columns[length] = F.when(F.col("_secret_spans").isNull(), F.col(length)).otherwise(F.length("_secret_text").cast("long"))
    changed = out.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
    return changed.unionByName(docs.where(~maybe))
