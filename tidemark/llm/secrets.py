"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by patterns. Each candidate's value is hashed, and the
hashes are counted over the whole corpus by distinct repositories and distinct
owners. A value that several owners share is a copied example; one that stays
with few owners and looks random is live. Pattern spans of the base kinds are
always reported. Bare tokens (long, mixed case and digits) are too common for
that and are added only where ownership makes them live.

Here a document is a repository and its source the owner.

Defined results: a null or empty text has no spans; null owners are one owner;
a null id is one repository; repeated rows are scanned row by row and count as
one repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

#: Kinds in report order: (name, pattern, group of the value, least length of the value, base kind).
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    ("hex", r"[0-9a-f]{24,}", 0, 24, True),
    ("bare", r"[A-Za-z0-9_-]{20,}", 0, 20, False),
)
#: A text without a match of this has no candidate of any kind.
ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|[A-Za-z0-9_-]{20}"""
#: A value that so many owners have is a copied example.
COPIED_OWNERS = 3
#: Words of values that stand for a secret.
PLACEHOLDER = r"(?i)example|changeme|placeholder|your|dummy|sample|xxxx|test|1234567"


def _looks_random(value: Column) -> Column:
    chars = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (chars >= 8) & ~value.rlike(PLACEHOLDER)


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, found). rows: row, doc_id of every document row. found: one row
    per span: row, repo, owner, no (of the kind), from_, to, value."""
    kept = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source",
            F.when(F.col("text").rlike(ANY), F.col("text")).alias("text"),
        ),
        "scanned",
    )
    found = None
    for no, (_, pattern, group, least, _) in enumerate(KINDS):
        whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
        # what lies between the matches: with their lengths it gives the places
        between = F.split("text", pattern, -1)
        some = kept.filter(F.col("text").rlike(pattern)).select("row", F.col("doc_id").alias("repo"), F.col("source").alias("owner"), F.posexplode(
            F.arrays_zip(F.transform(F.slice(between, 1, F.size(whole)), F.length).alias("gap"), F.transform(whole, F.length).alias("len"), value.alias("value"))).alias("k", "m"))
        upto = Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        some = some.select("row", "repo", "owner", "k", F.col("m.len").alias("len"), F.col("m.value").alias("value"), F.sum(F.col("m.gap") + F.col("m.len")).over(upto).alias("to"))
        some = some.filter(F.length("value") >= least)
        if not KINDS[no][4]:
            some = some.filter(F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]"))
        some = some.select("row", "repo", "owner", F.lit(no).alias("no"), (F.col("to") - F.col("len")).alias("from_"), "to", "value")
        found = some if found is None else found.union(some)
    return kept.select("row", "doc_id"), stored(found.withColumn("hash", F.sha2("value", 256)), "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repos, owners): distinct ones over the corpus. Rows are first made
    distinct by (hash, repository) and (hash, owner), so a hash that is
    everywhere is counted from partial sums."""
    repos = found.select("hash", "repo").distinct().groupBy("hash").agg(F.count("*").alias("repos"))
    owners = found.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    return repos.join(owners, "hash")


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows has row and doc_id; spans one row per reported span:
    row, no, from_, to, hash, repos, owners, live."""
    rows, found = candidates(docs)
    owned = found.join(ownership(found), "hash")
    live = (F.col("owners") < COPIED_OWNERS) & _looks_random(F.col("value"))
    owned = owned.select("row", "no", "from_", F.col("to").alias("to_"), "hash", "repos", "owners", live.alias("live"))
    extra = [no for no, k in enumerate(KINDS) if not k[4]]
    # an added span must be live and outside every base span of its row; a run over base spans sees the furthest end so far
    is_base = ~F.col("no").isin(extra)
    before = Window.partitionBy("row").orderBy("from_", "no").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("from_", "no").rowsBetween(1, Window.unboundedFollowing)
    owned = owned.withColumns({
        "end_before": F.max(F.when(is_base, F.col("to_"))).over(before),
        "next_from": F.min(F.when(is_base, F.col("from_"))).over(after),
    })
    apart = (F.coalesce("end_before", F.lit(0)) <= F.col("from_")) & (F.coalesce("next_from", F.col("to_")) >= F.col("to_"))
    return rows, owned.filter(is_base | (F.col("live") & apart)).drop("end_before", "next_from").withColumnRenamed("to_", "to")


def digest(docs: DataFrame) -> DataFrame:
    rows, found = spans(docs)
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("no") + 1)
    one = F.struct("from_", "no", F.concat_ws(":", kind, "from_", "to").alias("s"))
    base = ~F.col("no").isin([no for no, k in enumerate(KINDS) if not k[4]])
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    each = found.groupBy("row").agg(
        *[count(F.col("no") == no, f"n_{k[0]}") for no, k in enumerate(KINDS)],
        count(F.col("live"), "n_live"), count(F.col("owners") >= COPIED_OWNERS, "n_copied"),
        F.array_sort(F.collect_list(F.when(base, one))).alias("base"), F.array_sort(F.collect_list(one)).alias("all"),
    )
    text = lambda c: F.coalesce(F.array_join(F.col(c)["s"], ","), F.lit(""))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(each, "row", "left").select(
        "doc_id", *[n(f"n_{k[0]}") for k in KINDS], n("n_live"), n("n_copied"),
        F.sha2(text("base"), 256).alias("base_sha256"), text("all").alias("spans"),
    )
