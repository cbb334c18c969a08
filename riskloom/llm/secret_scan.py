"""Secret scans: candidate values are judged by how many repositories and owners of the corpus hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table, whole_text, written

# fixed values: kind, pattern, group of the value, least length of that group
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]+)", 1, 16),
]
#: spans that the ownership statistics add: the value of a candidate as a copied example or as a live credential
ADDED = ["example", "live"]
#: quick test that none of the patterns can have a match that counts
ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
SPANS = "array<struct<kind:int,begin:long,end:long,value_begin:long,value:string>>"


def _matches(text: Column, kind: int) -> Column:
    """Leftmost non-overlapping matches of a kind with their places, counted in code points.

    ``split`` gives the pieces between the matches, so a match begins where the pieces and matches before it
    end. Matches whose value is too short are dropped only after they have taken their characters. The value
    itself is kept as a digest.
    """
    name, pattern, group, least = KINDS[kind]
    found = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))),
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")),
        lambda gap, hit: F.struct(F.char_length(gap).cast("long").alias("gap"),
                                  F.char_length(hit["whole"]).cast("long").alias("size"), hit["value"].alias("value")))
    nothing = F.lit(None).cast(SPANS)

    def place(acc: Column, hit: Column) -> Column:
        begin = acc["at"] + hit["gap"]
        end = begin + hit["size"]
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("begin"), end.alias("end"),
                        (end - F.char_length(hit["value"])).cast("long").alias("value_begin"),
                        F.sha2(F.encode(hit["value"], "UTF-8"), 256).alias("value"))
        kept = F.when(F.char_length(hit["value"]) >= least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.coalesce(nothing, F.array().cast(SPANS)).alias("spans"))
    return F.aggregate(found, start, place, lambda acc: acc["spans"])


def _joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    table = F.array(*[F.lit(n) for n in names])
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"], s["kind"], s["end"])))
    return F.array_join(F.transform(in_order, lambda s: F.concat_ws(
        ":", F.get(table, s["kind"]), s["begin"].cast("string"), s["end"].cast("string"))), ",")


def find_candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """Every row with its base spans; written once, so that texts are read a single time."""
    text = whole_text(text_col)
    none = F.array().cast(SPANS)
    scanned = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), text.alias("scanned"))
    spans = F.when(F.col("scanned").rlike(ANY), F.concat(*[_matches(F.col("scanned"), k) for k in range(len(KINDS))]))
    return written(scanned.select("doc_id", "repo", "owner", F.monotonically_increasing_id().alias("row_no"),
                                  F.coalesce(spans, none).alias("base")), "secret-candidates")


def ownership(candidates: DataFrame, example_owners: int) -> DataFrame:
    """Per value digest: repositories and owners that hold it, and the kind of span it gets.

    Distinct (value, owner, repository), then (value, owner), then value: each step is summed up before its
    shuffle, so a value that a third of all rows hold is one row for each task.
    """
    held = candidates.select("owner", "repo", F.explode("base").alias("span")).select("owner", "repo", "span.value")
    by_owner = held.distinct().groupBy("value", "owner").agg(F.count("*").alias("repos"))
    by_value = by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    return by_value.select(F.col("value").alias("judged"), "owners", "repos", F.when(
        F.col("owners") >= example_owners, ADDED[0]).otherwise(ADDED[1]).alias("verdict"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id",
                owner_col: str = "source", example_owners: int = 3) -> DataFrame:
    """One row per row of ``docs``: n_assign, n_access, n_hex, n_example, n_live, base_sha256, spans.

    Base candidates come from three patterns. A candidate's value that ``example_owners`` or more distinct
    owners hold is a widely copied example, any other value looks like a live credential of its owner; each
    adds a span ``example`` or ``live`` over the value. Where every document is a repository of its own,
    ``repo_col`` is the document id. Values leave the scan as SHA-256 only.

    Null texts count as empty, a null repository or owner as one of its own name "". Repeated rows are judged
    apart from each other but are one repository. Empty tables give no rows; other columns are not read.
    """
    candidates = find_candidates(docs, id_col, text_col, repo_col, owner_col)
    # written first, so that adaptive execution can split the join at a value that very many documents hold
    judged = written(ownership(candidates, example_owners), "secret-owners")
    names = [k[0] for k in KINDS] + ADDED
    # one row for each value of a document, so that what comes back is small however often it is repeated
    values = candidates.select("row_no", F.explode(F.array_distinct(F.transform("base", lambda s: s["value"]))).alias("value"))
    verdicts = values.join(judged, F.col("value") == F.col("judged")).groupBy(F.col("row_no").alias("judged_row")).agg(
        F.map_from_entries(F.collect_list(F.struct("value", "verdict"))).alias("verdicts"))
    rows = candidates.join(verdicts, F.col("row_no") == F.col("judged_row"), "left")

    def added(span: Column) -> Column:
        verdict = F.try_element_at("verdicts", span["value"])
        return F.struct(F.when(verdict == ADDED[0], len(KINDS)).otherwise(len(KINDS) + 1).alias("kind"),
                        span["value_begin"].alias("begin"), span["end"].alias("end"),
                        span["value_begin"].alias("value_begin"), span["value"].alias("value"))

    def count(kind: int) -> Column:
        return F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{names[kind]}")

    every = F.concat("base", F.array_distinct(F.transform("base", added)))  # two kinds may have one value
    counts = [count(kind) for kind in range(len(names))]
    return rows.select("doc_id", *counts, F.sha2(F.encode(_joined(F.col("base"), names), "UTF-8"), 256).alias("base_sha256"),
                       _joined(every, names).alias("spans"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))
