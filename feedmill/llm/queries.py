"""The queries of the problems for training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import cleaning, encoding, history, mainbody, mixture, packing, pieces, repeats, spelling, tokens
from feedmill.shared import tables, written


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    (unified,) = tables(spark, sf_dir, "unified")
    return repeats.repeated_lines(unified)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return cleaning.surrounding_lines(unified, encoding.train(documents))


def p2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, sources = tables(spark, sf_dir, "pages", "sources")
    return mainbody.page_bodies(pages, sources)


def p1_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many blocks of each depth repeat in how many sources."""
    (unified,) = tables(spark, sf_dir, "unified")
    blocks, _ = repeats.repeated_blocks(unified)
    return blocks.groupBy("depth").agg(F.count(F.lit(1)).alias("blocks"), F.countDistinct("src").alias("sources"), F.max("rows").alias("most_rows"))


def p6_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both texts in one spelling, and the keys by which texts that look alike compare as equal."""
    (unified,) = tables(spark, sf_dir, "unified")
    texts = ["title", "content_text"]
    return spelling.with_keys(spelling.normalised(unified.select("item_no", *texts), texts), texts)


#: Ranges of batch numbers that p3_found takes one after another.
ARRIVALS = 4


def _arrivals(unified: DataFrame) -> list[Column] | None:
    """Conditions that split the rows into ranges of batch numbers in their order; rows without one come first."""
    low, high = unified.agg(F.min("batch_no"), F.max("batch_no")).first()
    if low is None:
        return None
    number = F.col("batch_no")
    ends = [low + (high - low + 1) * k // ARRIVALS for k in range(ARRIVALS + 1)]
    ranges = [(number >= a) & (number < b) for a, b in zip(ends, ends[1:])]
    return [ranges[0] | number.isNull(), *ranges[1:]]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return history.repeated_articles(unified, encoding.train(documents), _arrivals(unified))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return cleaning.garbled_fields(unified, encoding.train(documents)).select("item_no", "field_name")


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return cleaning.garbled_fields(unified, encoding.train(documents))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return cleaning.misspelt_fields(unified, encoding.train(documents))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified, documents = tables(spark, sf_dir, "unified", "documents")
    return cleaning.residue_items(unified, encoding.train(documents))


def _limits(spark: SparkSession, sf_dir: str) -> list[tuple[str, int, int]]:
    """The rows of token_limits, a table of fixed size."""
    (limits,) = tables(spark, sf_dir, "token_limits")
    return [tuple(r) for r in limits.select("limit_name", "capacity_tokens", "overlap_tokens").orderBy("capacity_tokens", "limit_name").collect()]


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return packing.packed(tokens.sized(documents), {name: capacity for name, capacity, _ in _limits(spark, sf_dir)})


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: one row for each capacity."""
    bins = p8_packed(spark, sf_dir).groupBy("limit_name").agg(F.max("container_no").alias("containers"), F.sum("n_tokens").alias("tokens"))
    (limits,) = tables(spark, sf_dir, "token_limits")
    return bins.join(limits, "limit_name").select("limit_name", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"))


def _mixed(spark: SparkSession, sf_dir: str, everything: bool = False) -> tuple[DataFrame, DataFrame]:
    """The mixture; ``everything`` asks for as many tokens as the listed sources have together, more than some can give."""
    documents, targets, sources = tables(spark, sf_dir, "documents", "mix_targets", "sources")
    # a source's domain is its host's last label; the catalogue is a table of fixed size
    domains = sources.groupBy(F.col("name").alias("source")).agg(F.max(F.regexp_extract("base_url", r"^[a-z]+://[^/:?#]*?([^./:?#]+)(?:[:/?#]|$)", 1)).alias("domain"))
    sizes = tokens.sized(documents, keep=("source", "lang")).join(F.broadcast(domains), "source", "left")
    total = None
    if everything:
        sizes = written(sizes, "sizes")
        total = sizes.join(targets.select("source").distinct(), "source", "left_semi").agg(F.sum("n_tokens")).first()[0] or 0
    return mixture.mixture(sizes, targets, ("domain", "lang"), total=total)


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[1]


def p9_shares_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir, everything=True)[1]


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return pieces.split(documents, _limits(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p1_blocks": p1_blocks, "p2_found": p2_found, "p2_pages": p2_pages, "p3_found": p3_found, "p4_found": p4_found, "p4_restored": p4_restored, "p6_found": p6_found, "p6_normalised": p6_normalised, "p7_found": p7_found, "p8_packed": p8_packed, "p8_fill": p8_fill, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_shares_full": p9_shares_full, "p10_pieces": p10_pieces}
