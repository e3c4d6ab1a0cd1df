"""Secret scans with corpus-wide ownership frequency.

Patterns find candidate secrets in whole texts.  Each candidate's value is hashed
and the hashes are counted over the corpus by distinct owners and repositories: a
value that many owners hold was copied from an example, a value that few hold looks
live unless it is a run or filler of few distinct characters.  The spans of the fixed kinds are always reported; a candidate of
the further kinds (keys with a vendor's prefix, private keys, signed tokens) is
added when its value is not widely copied.

DataFrame functions only.  Positions come from the pieces between the matches:
``split`` and ``regexp_extract_all`` walk a text the same way, so the lengths of
pieces and matches add up to code-point offsets.  Only documents that match at
all are staged and shuffled; counts are made per (value, owner, repository), then
per (value, owner), then per value, each combined map-side, so that a value that
a third of all documents hold meets no single task.

Defined cases: null and empty texts have no spans; a null owner or repository
counts as one value of its own; repeated rows are answered each for itself and
count once; an empty table gives an empty result; columns other than those named
are not read (``redacted`` passes them on untouched).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import free_name, staged

# Kinds in order, pattern, shortest whole match, shortest value (the group, where there is one).
BASE_KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 16, 16),
    ("hex", r"[0-9a-f]{32,}", 32, 32),
]
MORE_KINDS = [
    ("vendor", r"(?:gh[pousr]_|glpat-|sk_live_|rk_live_|xox[abprs]-|AIza|npm_)[A-Za-z0-9_-]{16,}", 20, 20),
    ("private", r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*", 64, 64),
    ("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 32, 32),
]
MOST_OWNERS = 3         # a value that more owners hold is a copied example
# Distinct characters of a live-looking value: LEAST_VARIETY, one more for every VARIETY_STEP characters over the first
# VARIETY_STEP, MOST_VARIETY at most.  Rejects runs and fillers; of random values, even of digits alone, under 1 in 5,000.
LEAST_VARIETY, VARIETY_STEP, MOST_VARIETY = 3, 8, 8
MARK = "<SECRET>"



def _matches(text: Column) -> Column:
    hit = F.lit(False)
    for _, pattern, _, _ in BASE_KINDS + MORE_KINDS:
        hit = hit | text.rlike(pattern)
    return F.coalesce(hit, F.lit(False))


def _candidates(rows: DataFrame) -> DataFrame:
    """(row, owner, repository, kind_no, kind, start, end, value) of every match that is long enough."""
    text = F.col("text")
    kinds = []
    for no, (kind, pattern, _, _) in enumerate(BASE_KINDS + MORE_KINDS):
        # every kind's arrays, empty where the text has no match
        found = F.when(text.rlike(pattern), F.arrays_zip(
            F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("gap"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")))
        kinds.append(F.struct(F.lit(no).alias("kind_no"), F.lit(kind).alias("kind"), found.alias("found")))
    each = rows.select("row", "owner", "repository", F.explode(F.array(*kinds)).alias("k")) \
        .select("row", "owner", "repository", "k.kind_no", "k.kind", F.posexplode("k.found").alias("place", "m")) \
        .select("row", "owner", "repository", "kind_no", "kind", "place", F.col("m.gap").alias("gap"), F.col("m.match").alias("match"))
    upto = Window.partitionBy("row", "kind_no").orderBy("place")
    each = each.withColumn("end", F.sum(F.length("gap") + F.length("match")).over(upto).cast("long")) \
        .withColumn("start", F.col("end") - F.length("match"))
    value = F.when(F.col("kind") == "assign", F.regexp_extract("match", BASE_KINDS[0][1], 1)).otherwise(F.col("match"))
    least_match, least_value = F.lit(0), F.lit(0)
    for kind, _, match_length, value_length in BASE_KINDS + MORE_KINDS:
        least_match = F.when(F.col("kind") == kind, match_length).otherwise(least_match)
        least_value = F.when(F.col("kind") == kind, value_length).otherwise(least_value)
    return each.withColumn("value", value) \
        .where((F.length("match") >= least_match) & (F.length("value") >= least_value)) \
        .select("row", "owner", "repository", "kind_no", "kind", "start", "end", "value")


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repositories) over the corpus."""
    per_repository = candidates.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repository.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def varied(value: Column) -> Column:
    """Whether a value has the distinct characters that its length asks for."""
    least = F.least(F.floor(F.length(value) / VARIETY_STEP) + (LEAST_VARIETY - 1), F.lit(MOST_VARIETY))
    return F.size(F.array_distinct(F.split(value, ""))) >= least


def judged(rows: DataFrame) -> DataFrame:
    """The candidates of ``rows`` (row, owner, repository, text) with n_owners, n_repositories and live."""
    found = staged(_candidates(rows).withColumn("value_hash", F.sha2(F.col("value"), 256))
                   .withColumn("varied", varied(F.col("value")))
                   .withColumn("value_length", F.length("value")).drop("value"), "candidates")
    counts = staged(ownership(found), "ownership")
    return found.join(counts, "value_hash").withColumn("live", (F.col("n_owners") <= MOST_OWNERS) & F.col("varied"))


def _hits(docs: DataFrame, key: Column, owner: Column, repository: Column, text: str) -> DataFrame:
    return staged(docs.where(_matches(F.col(text))).select(
        F.monotonically_increasing_id().alias("row"), key, owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"), F.col(text).alias("text")), "secret-hits")


def scanned(docs: DataFrame, key: str = "doc_id", owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans: every span as (start, kind_no, kind, end, live, n_owners), by start, then kind."""
    span = "array<struct<start:bigint,kind_no:int,kind:string,end:bigint,live:boolean,n_owners:bigint>>"
    hits = _hits(docs, F.col(key).alias("key"), F.col(owner), F.col(repository), text)
    kept = judged(hits).where((F.col("kind_no") < len(BASE_KINDS)) | (F.col("n_owners") <= MOST_OWNERS))
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("start", "kind_no", "kind", "end", "live", "n_owners"))).alias("spans"))
    answered = hits.select("row", "key").join(staged(spans, "spans"), "row", "left").select("key", F.col("spans").cast(span))
    rest = docs.where(~_matches(F.col(text))).select(F.col(key).alias("key"), F.lit(None).cast(span).alias("spans"))
    return answered.union(rest).select(
        F.col("key").alias(key), F.coalesce("spans", F.array().cast(span)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, key: str = "doc_id", owner: str = "source", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the values of live-looking secrets replaced by ``MARK``; copied examples stay."""
    row = free_name(docs, "secret_row")
    hits = staged(docs.where(_matches(F.col(text))).withColumn(row, F.monotonically_increasing_id()), "secret-hits")
    live = judged(hits.select(F.col(row).alias("row"), F.col(owner).cast("string").alias("owner"),
                              F.col(key).cast("string").alias("repository"), F.col(text).alias("text"))) \
        .where("live").select("row", (F.col("end") - F.col("value_length")).alias("start"), "end")
    by_start = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    islands = live.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)) \
        .withColumn("island", F.sum("new").over(by_start)) \
        .groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = staged(islands.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")), "cuts")
    name = free_name(hits, "cuts")
    joined = hits.join(cuts.select(F.col("row").alias(row), F.col("cuts").alias(name)), row, "left")
    at = lambda i: F.element_at(name, i)
    pieces = F.transform(F.sequence(F.lit(0), F.size(name)), lambda i: F.col(text).substr(
        F.when(i == 0, F.lit(1)).otherwise(at(F.greatest(i, F.lit(1)))["end"].cast("int") + 1),
        F.when(i == F.size(name), F.length(F.col(text))).otherwise(at(F.least(i + 1, F.size(name)))["start"].cast("int"))
        - F.when(i == 0, F.lit(0)).otherwise(at(F.greatest(i, F.lit(1)))["end"].cast("int"))))
    new = F.when(F.col(name).isNull(), F.col(text)).otherwise(F.array_join(pieces, MARK))
    changed = joined.withColumn(text, new)
    if length in docs.columns:
        changed = changed.withColumn(length, F.when(F.col(name).isNull(), F.col(length)).otherwise(
            F.length(F.col(text))).cast(docs.schema[length].dataType))
    return docs.where(~_matches(F.col(text))).unionByName(changed.select(*docs.columns))
