"""Problem 3: every batch is checked against all that was accepted before it.

A ``History`` is a folder that lasts from session to session. Each accepted batch leaves a segment in it: the keys of its
rows (page keys: urls without what does not choose the page; text keys), the minwise band keys of its new texts with the row
that stands for each, and these texts' signatures (the hashes of all their shingles). A segment's tables lie in hash
buckets, as many as its size asks for, so a batch reads only the buckets its own keys fall into, of a size that doesn't
grow with the history. A segment counts once its commit, one small file, is there; a batch committed before is not taken
again. Copies of a text share one representative, whose bands are all that is compared, so a text that stands in a third of
all rows costs no more than any other.

Within a bucket of equal band keys, members are first verified against the bucket's first member, which gives each its
distance to it. Of members then still apart only those are compared whose distances to the first differ by no more than two
like articles lie apart: distances of sets obey the triangle inequality, so no other pair can be alike.

Rows found to be the same article form a forest: each row that isn't the first of its article has the first row as it was
known then; links of a batch are followed to the present first rows and only these are joined anew.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import repeats
from feedmill.llm.cleaning import judged, marked
from feedmill.llm.encoding import Repairer
from feedmill.shared import cut, shared_dir, small_side, written

#: Words of a shingle and the share of all shingles that makes two articles one, as the project states them.
SHINGLE, SIMILARITY = 3, 0.8
#: Bands and rows of a band: two texts at the limit miss each other in all bands with probability (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
#: Rows of a bucket, about, for each table of a segment; and buckets of a segment, at most, as a power of two.
BUCKET_ROWS, MOST_BITS = {"keys": 100_000, "bands": 500_000, "signatures": 5_000, "parents": 500_000}, 12
#: Rows of two numbers up to which a side of a join is broadcast: 8 MB.
FEW = 500_000
#: Links up to which one task joins them: 16 MB.
ONE_TASK = 1_000_000
#: Query parameters that do not choose the page: fixed values.
TRACKING = r"^(?:utm_\w*|yclid|gclid|fbclid|ysclid|msclkid|dclid|mc_cid|mc_eid|_openstat|openstat|from|ref|referrer|igshid|_ga|cmpid|share)(?:=|$)"

_WORD = re.compile(r"\w+")
_PREPARED = "item long, page string, text_key string, signature binary, bands array<long>"
_TABLES = {"keys": "kind string, key string, first long", "bands": "key long, rep long", "signatures": "rep long, signature binary", "parents": "node long, parent long"}
#: What rows of a table lie in buckets by.
_HASHED = {"keys": F.xxhash64, "bands": lambda k: F.col(k) if isinstance(k, str) else k, "signatures": F.xxhash64, "parents": F.xxhash64}
_KEY = {"keys": "key", "bands": "key", "signatures": "rep", "parents": "node"}


def page_key(url: Column) -> Column:
    """What chooses the page: host without www and default port, decoded path without a last slash, sorted parameters.

    Null and blank urls have no key.
    """
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":(?:80|443)?$", ""), r"^www\.", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    path = F.when(path.contains("%"), F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)).otherwise(path)
    pairs = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING))
    return F.when(F.length(F.trim(url)) > 0, F.concat(host, F.regexp_replace(path, "/+$", ""), F.lit("?"), F.array_join(F.array_sort(pairs), "&")))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 7)
        return h


_HASHES = _Hashes()
_SEEDS = np.random.default_rng(20240917).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``SHINGLE`` words of every text, one after another, and where each text's begin.

    A shorter text is one shingle as a whole; a text without words has none.
    """
    words = np.fromiter((_HASHES[w] for ws in texts for w in ws), np.uint64)
    sizes = np.array([len(ws) for ws in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    parts = []
    with np.errstate(over="ignore"):
        mixed = words.copy()
        n = max(0, len(words) - SHINGLE + 1)
        mixed = mixed[:n] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(1, SHINGLE):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + words[k : n + k] * np.uint64(2 * k + 1)
        mixed ^= mixed >> np.uint64(29)
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a >= SHINGLE:
                parts.append(mixed[a : b - SHINGLE + 1])
            elif b > a:
                parts.append(np.array([np.bitwise_xor.reduce(words[a:b] * np.arange(3, 3 + b - a, dtype=np.uint64))], np.uint64))
            else:
                parts.append(np.zeros(0, np.uint64))
    counts = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts)))


def band_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise band keys, one row for each text that has shingles."""
    firsts = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(firsts), BANDS), np.uint64)
    if not len(firsts):
        return out.view(np.int64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            key = np.full(len(firsts), b + 1, np.uint64)
            for r in range(ROWS):
                a, c = _SEEDS[:, b * ROWS + r]
                least = np.minimum.reduceat((flat * a + c) >> np.uint64(16), firsts)
                key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
            out[:, b] = key
    return out.view(np.int64)


def prepared(df: DataFrame, repairer: Repairer, batches: list[Column], item: str = "item_no", url: str = "url", text: str = "content_text", source: str = "source") -> list[DataFrame]:
    """What the check needs of every row: page key, text key, the article's signature and its band keys; a frame a batch.

    Texts are judged without repeated lines and lines around the article, decoded and in one spelling; rows that are
    null, blank or residue, or of which nothing is left, have no text key and are judged by url alone.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in judged(batches, repairer):
            texts = [_WORD.findall("\n".join(x for n, (x, mine) in enumerate(zip(row[0], row[1]), 1) if mine and n not in row[2]).lower()) if row else [] for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("page"), *keyed(texts)], names=["item", "page", "text_key", "signature", "bands"])

    frequent = small_side(repeats.repeated_ids(df, source, item, text), repeats.FEW_SOURCES)
    out = []
    for chosen in batches:
        rows = df.where(chosen).select(F.col(item).alias("item"), F.col(source).alias("source"), F.col(text).alias("text"), page_key(F.col(url)).alias("page"))
        out.append(marked(rows, "source", "item", "text", ("page",), frequent).mapInArrow(keys, _PREPARED))
    return out


def keyed(texts: list[list[str]]) -> list[pa.Array]:
    """Text keys, signatures and band keys of texts as lists of words; nulls for those without words.

    A signature has 32 bits of each shingle's hash: of two articles of n shingles n^2 / 2^32 agree by chance, one in 10^5
    for articles of 200 words.
    """
    flat, starts = shingles(texts)
    small = (flat >> np.uint64(32)).astype(np.uint32)
    bands = iter(band_keys(flat, starts).tolist())
    return [
        pa.array([xxhash.xxh3_128_hexdigest(" ".join(t)) if t else None for t in texts], pa.string()),
        pa.array([np.unique(small[a:b]).tobytes() if b > a else None for a, b in zip(starts[:-1], starts[1:])], pa.binary()),
        pa.array([next(bands) if t else None for t in texts], pa.list_(pa.int64())),
    ]


def compared(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs (a, b): the shingles they share to those of both."""
    left, right = (signatures.select(F.col("rep").alias(c), F.col("signature").alias(f"{c}_s")) for c in ("a", "b"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column("a_s").to_pylist(), batch.column("b_s").to_pylist()):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                found.append(shared / (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_s", "b_s").mapInArrow(measure, "a long, b long, similarity double")


def least_nodes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (a, b) and the least node of each one's connected component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    a, b = np.split(ends.reshape(-1), 2)
    while len(at := np.flatnonzero(label[a] != label[b])):
        a, b = a[at], b[at]
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while np.any((up := label[label]) != label):
            label = up
    return nodes, nodes[label]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label) of all edges of a task."""
    parts = [[batch.column(c).to_numpy() for batch in found] for found in [list(batches)] for c in ("a", "b")]
    if parts[0]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in least_nodes(*map(np.concatenate, parts))], names=["node", "label"])


def classes(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, label): the least node of the connected component of each node of ``edges`` (a, b).

    If they are known to be ``most`` and these are no more than ``ONE_TASK``, one task joins them. Else large-star and
    small-star steps alternate until the edges are stars; each step's edges are checkpointed. Nodes without edges are absent.
    """
    if most is not None and most <= ONE_TASK:
        return edges.where("a <> b").select("a", "b").repartition(1).mapInArrow(_joined, "node long, label long")

    def told(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    was, after = told(now), now
    while was[0]:
        # large star: every larger neighbour of u links to u's least neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours link to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        after = cut(small)
        if (found := told(after)) == was:
            break
        now, was = after, found
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())


def bucket(hashed: Column, bits: int) -> Column:
    """The bucket of a hash: its first bits."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int") if bits else F.lit(0)


class History:
    """What was accepted so far, in a folder that all executors share; an existing folder is gone on with."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, (path or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}").rstrip("/")
        self._files = spark._jvm.org.apache.hadoop.fs.FileSystem.get(self._at(self.path).toUri(), spark._jsc.hadoopConfiguration())
        #: The segments in their order: folder, batch and for each table its bits and the buckets it has.
        self.segments: list[dict] = []
        commits = self._at(f"{self.path}/commits")
        if self._files.exists(commits):
            names = sorted(x.getPath().toString() for x in self._files.listStatus(commits))
            self.segments = [json.loads(r[0]) for r in sorted(spark.read.text(names, wholetext=True).select("value", F.input_file_name().alias("f")).collect(), key=lambda r: r[1])] if names else []

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _put(self, df: DataFrame, table: str, folder: str, rows: int) -> dict:
        """Writes a table of a new segment in buckets; what the commit says of it."""
        bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS[table]))))
        if rows:
            out = df.withColumn("bucket", bucket(_HASHED[table](_KEY[table]), bits))
            if bits:
                out = out.hint("rebalance", "bucket")
            out.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{folder}/{table}")
        at = self._at(f"{folder}/{table}")
        names = [x.getPath().getName() for x in self._files.listStatus(at)] if rows else []
        return {"bits": bits, "buckets": sorted(int(n[7:]) for n in names if n.startswith("bucket="))}

    def probed(self, table: str, keys: DataFrame) -> DataFrame | None:
        """The rows of the table's buckets that ``keys`` (a column named as the table's key) fall into, of all segments;
        null if there are none. Of the keys only the numbers of their buckets, 2^12 at most, reach the driver."""
        held = [(s["folder"], s[table]) for s in self.segments if s[table]["buckets"]]
        if not held:
            return None
        most = max(t["bits"] for _, t in held)
        wanted = {0} if not most else {r[0] for r in keys.select(bucket(_HASHED[table](_KEY[table]), most)).distinct().collect()}
        paths = []
        for folder, t in held:
            near = {w >> (most - t["bits"]) for w in wanted}
            paths += [f"{self.path}/{folder}/{table}/bucket={b}" for b in t["buckets"] if b in near]
        return self.spark.read.schema(_TABLES[table]).parquet(*paths) if paths else None

    def roots(self, nodes: DataFrame) -> tuple[DataFrame, int] | None:
        """(node, root), the first row of the article of each node as it is known now, and their number; null if no row
        repeats another so far.

        A first row can only have got a parent in a later segment, so there are no more steps up than segments with parents.
        """
        now, n = nodes.select("node", F.col("node").alias("root")), None
        for _ in range(sum(bool(s["parents"]["buckets"]) for s in self.segments)):
            if (held := self.probed("parents", now.select(F.col("root").alias("node")))) is None:
                break
            up = held.select(F.col("node").alias("root"), "parent")
            after, n = self._counted(now.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root"), F.col("parent").isNotNull().alias("moved")), "roots", moved=F.col("moved"))
            now = after.select("node", "root")
            if not n["moved"]:
                break
        return (now, n["rows"]) if n else None

    def add(self, arriving: DataFrame, batch: str | None = None) -> None:
        """Checks a prepared batch against itself and everything before it, and appends its keys and the links found.

        A batch of a name that was committed before changes nothing. What a failed batch has written counts for nothing.
        """
        if batch is not None and any(s["batch"] == batch for s in self.segments):
            return
        name = f"segment-{len(self.segments):09d}-{uuid.uuid4().hex}"
        folder = f"{self.path}/{name}"
        try:
            self._commit(self._segment(arriving, name, batch, folder))
        finally:
            self._files.delete(self._at(f"{folder}-work"), True)

    def _segment(self, arriving: DataFrame, name: str, batch: str | None, folder: str) -> dict:
        """Writes a batch's segment; tables that only this takes lie in a folder beside it."""
        self._work = f"{folder}-work"
        rows, _ = self._counted(arriving, "arriving")
        segment: dict = {"folder": name, "batch": batch}
        # keys: links to the earliest row that has one; those nobody had before are new
        kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("page", "text_key")])).alias("x")
        seen = rows.select("item", kinds).select("item", "x.*").where("key is not null")
        firsts = seen.groupBy("kind", "key").agg(F.min("item").alias("first"))
        if any(s["keys"]["bits"] for s in self.segments):
            firsts, _ = self._counted(firsts, "firsts")
        old = self.probed("keys", firsts)
        found = firsts.withColumn("old", F.lit(None).cast("long")) if old is None else firsts.join(old.select("kind", "key", F.col("first").alias("old")), ["kind", "key"], "left")
        known, fresh = self._counted(found, "known", keys=F.col("old").isNull(), texts=F.col("old").isNull() & (F.col("kind") == "text_key"))
        links = seen.join(known, ["kind", "key"]).select(F.coalesce("old", "first").alias("a"), F.col("item").alias("b"))
        segment["keys"] = self._put(known.where("old is null").select("kind", "key", "first"), "keys", folder, fresh["keys"])
        # texts that no row had before, each with the row that stands for it
        n = fresh["texts"]
        texts = rows.join(small_side(known.where("old is null and kind = 'text_key'").select(F.col("first").alias("item")), FEW, n), "item", "left_semi")
        segment["bands"] = self._put(texts.select(F.explode("bands").alias("key"), F.col("item").alias("rep")), "bands", folder, n * BANDS)
        segment["signatures"] = self._put(texts.select(F.col("item").alias("rep"), "signature"), "signatures", folder, n)
        alike = self._alike(segment) if n else None
        # links between rows lead to links between first rows as they are now; these are joined anew
        links, told = self._counted((links if alike is None else links.unionByName(alike)).where("a <> b").distinct(), "links")
        if roots := self.roots(links.select(F.explode(F.array("a", "b")).alias("node")).distinct()):
            for c in ("a", "b"):
                end = roots[0].select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
                links = links.join(small_side(end, FEW, roots[1]), c)
            links = links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        parents = classes(links, told["rows"]).where("node <> label").select("node", F.col("label").alias("parent"))
        segment["parents"] = self._put(parents, "parents", folder, told["rows"])
        return segment

    def _counted(self, df: DataFrame, name: str, **held: Column) -> tuple[DataFrame, dict[str, int]]:
        """``df`` written beside the segment and read again, and how many rows it has (``rows``) and how many of them hold
        each condition, counted as they are written."""
        path, seen = f"{self._work}/{name}-{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in held.items()]).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get

    def _alike(self, segment: dict) -> DataFrame:
        """Pairs (a, b) of like articles of which at least one is in the new segment."""
        mine, before = History.__new__(History), self.segments
        mine.spark, mine.path, mine.segments = self.spark, self.path, [segment]
        new = mine._all("bands")
        old = self.probed("bands", new) if before else None
        everything = new.withColumn("new", F.lit(True))
        if old is not None:
            everything = everything.unionByName(old.join(new.select("key").distinct(), "key", "left_semi").withColumn("new", F.lit(False)))
        # one member a bucket that all others are verified against
        firsts, n = self._counted(everything.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.max("new").alias("new")).where("a <> z and new").select("key", "a"), "pivots")
        members, _ = self._counted(everything.join(small_side(firsts, FEW, n["rows"]), "key").select("key", "a", F.col("rep").alias("b")), "members")
        ids, n = self._counted(members.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "candidates")
        held = self.probed("signatures", ids)
        signatures = mine._all("signatures") if held is None else mine._all("signatures").unionByName(held)
        signatures = signatures.join(small_side(ids, FEW, n["rows"]), "rep", "left_semi")
        like = F.col("similarity") >= SIMILARITY - 1e-9
        stars, n = self._counted(compared(members.where("a <> b").select("a", "b").distinct(), signatures), "stars", like=like)
        labels, n = self._counted(classes(stars.where(like).select("a", "b"), n["like"]), "labels")
        # members whose class differs from another member's of the bucket are compared if their distances to its first allow it
        of = members.join(small_side(labels.withColumnRenamed("node", "b"), FEW, n["rows"]), "b", "left").join(stars, ["a", "b"], "left")
        of = of.select("key", "b", F.coalesce("label", "b").alias("label"), (1 - F.coalesce("similarity", F.lit(1.0))).alias("far"))
        apart = of.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y and n > 2").select("key")
        mixed, n = self._counted(of.join(apart, "key"), "mixed")
        found = stars.where(like).select("a", "b")
        if not n["rows"]:
            return found
        near = F.abs(F.col("l.far") - F.col("r.far")) <= 1 - SIMILARITY + 1e-9
        across = mixed.alias("l").join(mixed.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.b") < F.col("r.b")) & (F.col("l.label") != F.col("r.label")) & near)
        across = across.select(F.col("l.b").alias("a"), F.col("r.b").alias("b")).distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti")
        return found.unionByName(compared(self._counted(across, "across")[0], signatures).where(like).select("a", "b"))

    def _all(self, table: str) -> DataFrame:
        """A table of all segments."""
        paths = [f"{self.path}/{s['folder']}/{table}/bucket={b}" for s in self.segments for b in s[table]["buckets"]]
        return self.spark.read.schema(_TABLES[table]).parquet(*paths) if paths else self.spark.createDataFrame([], _TABLES[table])

    def _commit(self, segment: dict) -> None:
        """Makes the segment count, in one step: its commit is a file that nobody may have made before."""
        at = self._at(f"{self.path}/commits/{len(self.segments):09d}.json")
        out = self._files.create(at, False)
        out.write(json.dumps(segment).encode())
        out.close()
        self.segments.append(segment)

    def repeats(self) -> DataFrame:
        """(first, item) of every row that repeats an earlier article, with that article's first row."""
        now = self._all("parents").select(F.col("node").alias("item"), F.col("parent").alias("first"))
        # a path up the forest has as many steps as segments, at most; each round halves it
        for _ in range(max(0, math.ceil(math.log2(max(1, len(self.segments)))))):
            up = now.select(F.col("item").alias("first"), F.col("first").alias("above"))
            now = written(now.join(up, "first", "left").select("item", F.coalesce("above", "first").alias("first")), "firsts")
        return now.select("first", "item")


def repeated_articles(df: DataFrame, repairer: Repairer, batches: list[Column] | None = None, item: str = "item_no", **columns: str) -> DataFrame:
    """(first_item_no, item_no) of the rows that repeat an earlier article, with the earliest row of that article.

    ``batches`` are conditions over ``df`` that split it into what arrives one after another; by default all rows arrive at
    once. Which lines repeat in their source is judged over all of ``df``.
    The result is the same for every split. Rows without url and text repeat nothing; of copies the least item comes first.
    """
    history = History(df.sparkSession)
    for arriving in prepared(df, repairer, batches or [F.lit(True)], item, **columns):
        history.add(arriving)
    return history.repeats().select(F.col("first").alias("first_item_no"), F.col("item").alias("item_no"))
