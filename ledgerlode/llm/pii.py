"""Personal data by patterns and bootstrapped contexts, in DataFrame operations only.

Base matches of four kinds come from fixed patterns, with code-point offsets got from
the lengths of the matches and of the gaps between them. They are the seeds of a
bootstrap. Any string of at least ``LEAST`` characters with a digit, an at sign or a
bracket, whatever its shape, is a candidate, groups of digits with single spaces between
them taken together; what overlaps a base match is none. The lexical patterns of a place
are the word before it, the two words before it, the word after it, and the words on
both sides.

Patterns and instances (seeds and candidates, each distinct string once) form a graph. In
each of ``ROUNDS`` rounds, a pattern's score for a kind is the trust in its instances of
that kind over the number of all its instances, and counts where it is at least
``CONFIDENCE`` and the pattern has at least ``SUPPORT`` trusted instances of the kind. A
candidate's trust is the probability that not all such patterns of its are wrong, each
being wrong by ``DOUBT`` at least; with ``TRUSTED`` or more it is an instance of its best
kind that supports patterns in the next round, so a pattern that no seed has can be found
through candidates that other patterns found. What is trusted after the last round is
added, wherever it stands; base spans stay as they are.

Texts are read once and never shuffled: the scan leaves offsets, strings and words around
them. What many rows share is aggregated before every shuffle and salted in joins, and
nothing is collected.

The regular expressions are possessive where a plain loop would recurse, so long runs
can't overflow the stack, and start only where a run starts, so they stay linear.

Null and empty texts have no spans. Rows that repeat a doc_id keep their own spans. Ties
between kinds go to the one listed first. An empty table gives no rows. A kept column
named ``spans`` raises ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.llm.common import checkpoint, kept_columns, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE, SUPPORT, DOUBT = 0.7, 3, 0.1
TRUSTED = CONFIDENCE * (1 - DOUBT)
LEAST = 6
#: Parts that the rows of one pattern or one string are dealt into where they are joined.
SALT = 16

#: Streams of matches: those of the base patterns, and the candidates.
STREAMS = {
    # A match starts where no longer one could, or where the last one ended.
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "any": r"(?<![^\s{S}])[^\s{S}0-9@\[(]*+[0-9@\[(][^\s{S}]*+(?:(?<=[0-9)])\x20\(?[0-9][^\s{S}]*+)*+".replace("{S}", r"""\"'<>|=,;!?$%&*#"""),
}
#: What each text with a match of the stream holds; cheap to test first.
_NEEDS = {"email": "contains(text, '@')", "phone": "contains(text, '+') and digit", "any": "text rlike '[0-9@\\\\[(]'"}
_BEFORE = r"(?:(\p{L}+)[^\p{L}]{1,3})?(\p{L}+)[^\p{L}\p{N}]{0,4}$"
_AFTER = r"^[^\p{L}\p{N}]{0,4}(\p{L}+)"
_HIT = "array<struct<stream:string,i:int,gap:int,value:string,second:string,first:string,after:string>>"


def _hits(stream: str) -> str:
    """SQL for the stream's matches in order, a ``_HIT``: gap is the length of the text since the match before; the words are the two before and the one after."""
    p = "r'" + STREAMS[stream].replace("'", r"\x27") + "'"
    around = f"zip_with(zip_with(regexp_extract_all(text, {p}, 0), split(text, {p}, -1), (m, g) -> struct(m, g)), slice(split(text, {p}, -1), 2, 2000000000), (v, n) -> struct(v.m, v.g, n))"
    word = lambda x, p, k: f"lower(regexp_extract({x}, r'{p}', {k}))"
    left, right = "right(v.g, 48)", "left(v.n, 48)"
    row = f"transform(filter({around}, v -> v.m is not null), (v, i) -> struct('{stream}' as stream, i as i, length(v.g) as gap, v.m as value, {word(left, _BEFORE, 1)} as second, {word(left, _BEFORE, 2)} as first, {word(right, _AFTER, 1)} as after))"
    return f"case when {_NEEDS.get(stream, 'digit')} then {row} else cast(array() as {_HIT}) end"


def _matches(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (row, kept) of all documents, and rows (row, kind, start, end, value, second, first, after) of base matches and, with a null kind, of candidates."""
    kept_columns(docs, keep, "text", {"spans": ""})
    texts = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("digit", F.expr("text rlike '[0-9]'"))
    hits = F.flatten(F.array(*(F.expr(_hits(s)) for s in STREAMS)))
    scanned = checkpoint(texts.select(F.monotonically_increasing_id().alias("row"), "kept", hits.alias("hits")))
    each = scanned.where(F.size("hits") > 0).select("row", F.inline("hits"))
    end = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("row", "stream").orderBy("i"))
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    digits = F.regexp_replace("value", "[^0-9]", "")
    placed = placed.withColumn("digits", digits).withColumn("n", F.length("digits"))
    small = " and ".join(f"length(ltrim('0', split_part(value, '.', {k}))) <= 3 and int(right('000' || ltrim('0', split_part(value, '.', {k})), 3)) <= 255" for k in (1, 2, 3, 4))
    luhn = "aggregate(transform(split(reverse(left(digits, 19)), ''), (d, i) -> if(i % 2 = 0, int(d), if(int(d) > 4, int(d) * 2 - 9, int(d) * 2))), 0, (a, d) -> a + coalesce(d, 0)) % 10 = 0"
    good = F.expr(f"case stream when 'ip' then {small} when 'card' then n between 12 and 19 and {luhn} when 'phone' then n between 9 and 15 else true end")
    # candidates without marks of the sentence around them, and without brackets whose other half they lack
    ends = F.regexp_replace("value", F.when(F.col("value").contains("("), r"[.:/(\[+-]+$").otherwise(r"[.:/)(\[+-]+$"), F.lit(""))
    bare = F.when(F.col("value").startswith("(") & ~F.col("value").contains(")"), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    any_one = F.col("stream") == "any"
    placed = placed.where(good).withColumn("value", F.when(any_one, ends).otherwise(F.col("value"))).withColumn("whole", F.col("value"))
    placed = placed.withColumn("value", F.when(any_one, bare).otherwise(F.col("value")))
    placed = placed.withColumn("start", F.col("start") + F.length("whole") - F.length("value")).withColumn("end", F.col("start") + F.length("value"))
    placed = placed.where(f"stream <> 'any' or length(value) >= {LEAST}").withColumn("kind", F.when(F.col("stream") != "any", F.col("stream")))
    # a base match that starts before a candidate's end and ends after its start
    near = Window.partitionBy("row").orderBy("start", "stream")
    base_end, base_start = F.when(F.col("kind").isNotNull(), F.col("end")), F.when(F.col("kind").isNotNull(), F.col("start"))
    marked = placed.withColumn("reached", F.max(base_end).over(near.rowsBetween(Window.unboundedPreceding, 0)))
    marked = marked.withColumn("ahead", F.min(base_start).over(near.rowsBetween(0, Window.unboundedFollowing)))
    clear = F.col("kind").isNotNull() | (F.coalesce(F.col("reached"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("ahead"), F.col("end")) >= F.col("end"))
    return scanned.select("row", "kept"), marked.where(clear).select("row", "kind", "start", "end", "value", "second", "first", "after")


def _patterns() -> Column:
    """The lexical patterns of a match."""
    second, first, after = F.col("second"), F.col("first"), F.col("after")
    named = lambda mark, ok, *parts: F.when(ok, F.concat_ws(" ", F.lit(mark), *parts))
    left, right = first != "", after != ""
    return F.array_compact(F.array(named("1", left, first), named("2", left & (second != ""), second, first), named("3", right, after), named("4", left & right, first, after)))


def _salted(few: DataFrame) -> DataFrame:
    return few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def discovered(found: DataFrame) -> DataFrame:
    """(kind, value) of the candidates among ``found`` that the bootstrap trusts."""
    edges = found.select("kind", "value", F.explode(_patterns()).alias("pattern")).distinct()
    edges = checkpoint(edges.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALT)).cast("int")))
    whole = checkpoint(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(f"n >= {SUPPORT}"))
    seeds = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count("*").cast("double").alias("trust"), F.count("*").alias("support"))
    seeds, open_edges = checkpoint(seeds), edges.where("kind is null").drop("kind")
    trusted = None
    for _ in range(ROUNDS):
        good = seeds
        if trusted is not None:
            own = open_edges.join(_salted(trusted).withColumnRenamed("salt", "part"), (open_edges.value == trusted.value) & (F.pmod(F.xxhash64("pattern"), F.lit(SALT)) == F.col("part"))).select("pattern", "kind", "trust")
            good = good.union(own.groupBy("pattern", "kind").agg(F.sum("trust"), F.count("*")))
            good = good.groupBy("pattern", "kind").agg(F.sum("trust").alias("trust"), F.sum("support").alias("support"))
        known = good.where(f"support >= {SUPPORT}").join(whole, "pattern").select("pattern", "kind", (F.col("trust") / F.col("n")).alias("score")).where(f"score >= {CONFIDENCE}")
        reached = open_edges.join(_salted(known), ["pattern", "salt"])
        value = reached.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("score") * (1 - DOUBT))))).alias("trust"))
        order = F.expr("array_position(array({}), kind)".format(", ".join(f"'{k}'" for k in KINDS)))
        best = value.groupBy("value").agg(F.max(F.struct("trust", (-order).alias("order"), "kind")).alias("b"))
        trusted = checkpoint(best.select("value", "b.kind", "b.trust").where(f"trust >= {TRUSTED}"))
    return trusted.select("kind", "value")


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with spans: array of struct<start, rank, end, kind, base>, by start, then kind."""
    rows, found = _matches(docs, keep)
    found = checkpoint(found)
    candidates = found.where("kind is null").select("row", "start", "end", "value", F.pmod(F.xxhash64("row", "start"), F.lit(SALT)).cast("int").alias("salt"))
    added = candidates.join(_salted(discovered(found)), ["value", "salt"]).select("row", "kind", "start", "end", F.lit(False).alias("base"))
    order = F.expr("array_position(array({}), kind)".format(", ".join(f"'{k}'" for k in KINDS)))
    both = found.where("kind is not null").select("row", "kind", "start", "end", F.lit(True).alias("base")).union(added)
    listed = both.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), order.alias("rank"), F.col("end").cast("long").alias("end"), "kind", "base"))).alias("spans"))
    empty = F.expr("cast(array() as array<struct<start:bigint,rank:bigint,end:bigint,kind:string,base:boolean>>)")
    return rows.join(listed, "row", "left").select("kept.*", F.coalesce("spans", empty).alias("spans"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), ["doc_id"])
    text = lambda where: F.array_join(F.expr(f"transform({where}, x -> concat_ws(':', x.kind, x.start, x.end))"), ",")
    counts = [F.expr(f"cast(size(filter(spans, x -> x.base and x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("filter(spans, x -> x.base)"), 256).alias("base_sha256"), text("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


QUERIES = {"op2_pii": op2_pii}
ORACLE: dict[str, str] = {}
