"""Near-duplicate documents: MinHash, banding, verification, alternating stars.

Method. A document's set holds its distinct k-word shingles, as 64-bit
hashes. Documents with equal sets form one class first (an aggregation, so
thousands of copies cost one row per task); only the class's smallest id
goes on. `bands x rows` universal hash functions give its minima. Documents
meet in a bucket when the minima of one band agree. In each bucket every
member is paired with one centre (a star, linear in the bucket): the member
whose buckets hold the most documents altogether, which among edited copies
is the text that they were made from. The pairs' signatures are compared,
and pairs that may reach the threshold are confirmed on the full sets. The
confirmed links go through alternating large-star and small-star rounds.

A star alone could miss a link between two members that both fail against
the centre. So a second pass looks at the buckets that still hold more than
one component and compares, in blocks, the members of different components
there; what it confirms is added and the components are formed again. Only
connectivity is reported, so pairs inside one component need no check. No
bucket is capped and none is collected into one task.

With 32 bands of 5 rows a pair at exactly 0.8 misses every bucket with
probability 3e-6; the signature filter (320 one-byte minima, limit 0.725)
loses such a pair with 3e-4, and pairs above it far more rarely.

Null or blank texts have an empty set: component of their own. A null
doc_id cannot be named by a link: its row gets a null component and is
kept. Rows that repeat a doc_id are one node. An empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, ascii_lower_words, bound_batches

BANDS, ROWS = 32, 5
MINIMA = 320
# Over three standard deviations under 0.8, for a share of 320 one-byte minima.
SIGNATURE_LIMIT = 0.725
# Members of a bucket compared with each other in one task.
BLOCK = 256
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_WORD_CACHE = 1 << 16


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    n = MINIMA
    seeds = np.arange(1, 2 * n + 1, dtype=np.uint64) * _PRIME
    mixed = _mix(seeds)
    return mixed[:n] | np.uint64(1), mixed[n:]


class Shingler:
    """Distinct shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, shingle_words: int):
        self.k = shingle_words
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = ascii_lower_words(text)
        if not words:
            return np.empty(0, np.uint64)
        seen = self.seen
        if len(seen) > _WORD_CACHE:
            seen.clear()
        hashes = []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        a = np.array(hashes, dtype=np.uint64)
        n = max(1, len(a) - self.k + 1)
        acc = np.full(n, min(len(a), self.k), np.uint64)
        for i in range(min(len(a), self.k)):
            acc = acc * _PRIME + a[i : i + n]
        return np.unique(_mix(acc))


def signature(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of every universal hash (multiply, add, high bits) over the set."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(sets), 2048):
        part = sets[start : start + 2048, None] * a[None, :] + b[None, :]
        np.minimum(low, part.min(axis=0), out=low)
    return low >> np.uint64(16)


def _sketch(k: int):
    @F.pandas_udf("n_shingles long, digest binary, keys array<long>, sig binary")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingles, (a, b) = Shingler(k), _coefficients()
        salt = np.arange(1, BANDS + 1, dtype=np.uint64) * _PRIME
        for batch in texts:
            rows = []
            for text in batch:
                s = shingles(text)
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                low = signature(s, a, b)
                keys = np.zeros(BANDS, np.uint64)
                for column in low[: BANDS * ROWS].reshape(BANDS, ROWS).T:
                    keys = _mix(keys * _PRIME + column)
                rows.append(
                    (
                        len(s),
                        xxhash.xxh3_128_digest(s.tobytes()),
                        _mix(keys + salt).view(np.int64),
                        _mix(low).astype(np.uint8).tobytes(),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_shingles", "digest", "keys", "sig"])

    return run


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        if len(batch):
            left = np.frombuffer(b"".join(batch["sig_a"]), np.uint8).reshape(len(batch), -1)
            right = np.frombuffer(b"".join(batch["sig_b"]), np.uint8).reshape(len(batch), -1)
            batch = batch[(left == right).mean(axis=1) >= SIGNATURE_LIMIT]
        yield batch[["a", "b"]]


def _verify(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(k)
        last: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(
                batch["a"], batch["text_a"], batch["text_b"], strict=True
            ):
                if last[0] != a:
                    last = (a, shingles(text_a))
                x, y = last[1], shingles(text_b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return run


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose sizes and signatures may reach the threshold."""
    sig = sketches.select("doc_id", "sig", "n_shingles")
    both = pairs.join(sig.toDF("a", "sig_a", "n_a"), "a").join(sig.toDF("b", "sig_b", "n_b"), "b")
    sized = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sig_a", "sig_b").mapInPandas(_alike, "a long, b long")


def _confirmed(near: DataFrame, docs: DataFrame, scratch: Scratch, name: str, k: int,
               percent: int) -> DataFrame:
    """Of the pairs (a, b) of a table, those that reach the threshold on full sets."""
    ids = scratch.save(
        near.select("a").union(near.select("b")).distinct().toDF("doc_id"), f"{name}-ids"
    )
    texts = scratch.save(
        docs.join(ids, "doc_id", "left_semi").select("doc_id", "text"), f"{name}-texts"
    )
    joined = (
        near.join(texts.toDF("b", "text_b"), "b")
        .join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_a", "text_b")
    )
    links = scratch.save(joined.mapInPandas(_verify(k, percent), "a long, b long"), f"{name}-links")
    scratch.drop(f"{name}-texts")
    return links


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(doc_id, component_id) of every linked node, by alternating stars.

    `links` has columns a, b. Large-star moves a node's larger neighbours
    to its smallest one, small-star the smaller; both are a partial
    aggregation and a join, so a centre of thousands of links is split like
    any hot key. Rounds end when large-star leaves the star forest as it is.
    """
    def with_least(edges: DataFrame, step: str) -> DataFrame:
        """Edges (u, v) with the least of u and all its v, as a bare join."""
        least = edges.groupBy("u").agg(F.min("v").alias("least"))
        least = scratch.save(least, f"{step}-least")
        return edges.join(least.withColumn("least", F.least("u", "least")), "u")

    def figure(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = scratch.save(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        f"{name}-0",
    )
    before = figure(edges)
    step = 0
    while before[0]:
        step += 1
        both = edges.union(edges.select("v", "u"))
        large = (
            with_least(both, f"{name}-{step}-large")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = scratch.save(large, f"{name}-{step}-large")
        # Every edge now has u > v. Small-star: u and its v all to the least.
        least = with_least(large, f"{name}-{step}-small")
        small = (
            least.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = scratch.save(small, f"{name}-{step}")
        after = figure(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))


def _cross_pairs(percent: int):
    """Pairs of different components in each block of a bucket that may be links.

    Rows arrive sorted by (bucket, block pair); a block pair has at most two
    blocks of rows, held only until the next begins. A pair that shares
    several buckets is given in the first of them.
    """

    def pairs(held: list) -> list[tuple[int, int]]:
        if len(held) < 2:
            return []
        doc, component, block = (
            np.array([getattr(r, c) for r in held]) for c in ("doc_id", "component_id", "block")
        )
        size = np.array([r.n_shingles for r in held])
        sig = np.frombuffer(b"".join(r.sig for r in held), np.uint8).reshape(len(held), -1)
        keys = np.array([r.keys for r in held])
        apart = held[0].i != held[0].j
        out = []
        for n in range(len(held) - 1):
            rest = slice(n + 1, None)
            least, most = np.minimum(size[n], size[rest]), np.maximum(size[n], size[rest])
            ok = (component[rest] != component[n]) & (100 * least >= percent * most)
            if apart:
                ok &= block[rest] != block[n]
            at = np.flatnonzero(ok) + n + 1
            if len(at):
                at = at[(sig[at] == sig[n]).mean(axis=1) >= SIGNATURE_LIMIT]
            if len(at):
                first = np.argmax(keys[at] == keys[n], axis=1)
                at = at[keys[n][first] == held[0].key]
            out += [(min(doc[n], doc[m]), max(doc[n], doc[m])) for m in at]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in batch.itertuples(index=False):
                if held and (row.key, row.i, row.j) != (held[0].key, held[0].i, held[0].j):
                    out += pairs(held)
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(pairs(held), columns=["a", "b"], dtype="int64")

    return run


def _crossing(members: DataFrame, heads: DataFrame, components: DataFrame, scratch: Scratch,
              percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and may be links."""
    named = scratch.save(
        members.join(components, "doc_id", "left").withColumn(
            "component_id", F.coalesce("component_id", "doc_id")
        ),
        "named",
    )
    mixed = (
        named.groupBy("key")
        .agg(
            F.min("component_id").alias("least"),
            F.max("component_id").alias("most"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("least <> most")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    mixed = scratch.save(mixed, "mixed")
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    rows = (
        named.join(mixed, "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "doc_id",
            "component_id",
        )
    )
    rows = rows.join(heads.select("doc_id", "n_shingles", "sig", "keys"), "doc_id")
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return scratch.save(
        dealt.mapInPandas(_cross_pairs(percent), "a long, b long").distinct(), "crossing"
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, scratch: Scratch | None = None
) -> DataFrame:
    """One row per document: doc_id, n_shingles, digest, component_id, kept.

    Links documents with 100 * common >= `percent` * union of their distinct
    `shingle_words`-word shingles (fewer words: the whole sequence is one).
    `component_id` is the smallest id reachable over links.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    sketches = scratch.save(
        docs.withColumn("sketch", _sketch(shingle_words)("text")).select("doc_id", "sketch.*"),
        "sketches",
    )
    # A class is the documents with one and the same set.
    classes = scratch.save(
        sketches.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first")),
        "classes",
    )
    first = classes.select("digest", F.col("first").alias("doc_id"))
    heads = scratch.save(
        sketches.join(first, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"]),
        "heads",
    )
    buckets = heads.select("doc_id", F.explode("keys").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.save(
        buckets.join(scratch.save(sizes, "sizes"), "key"), "members"
    )
    # How many documents a document meets, over all its buckets.
    met = members.groupBy("doc_id").agg(F.sum("n").alias("met"))
    members = scratch.save(
        members.select("doc_id", "key").join(scratch.save(met, "met"), "doc_id"), "met-members"
    )
    centre = members.groupBy("key").agg(F.max("met").alias("most"))
    centre = (
        members.join(scratch.save(centre, "most"), "key")
        .where("met = most")
        .groupBy("key")
        .agg(F.min("doc_id").alias("centre"))
    )
    stars = (
        members.join(scratch.save(centre, "centres"), "key")
        .where("doc_id <> centre")
        .select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
    near = scratch.save(_near(stars, heads, percent), "star-near")
    links = _confirmed(near, docs, scratch, "star", shingle_words, percent)
    # Rows that repeat a doc_id with other texts tie its classes together.
    tied = sketches.join(classes, "digest").where("doc_id <> first")
    repeated = (
        tied.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
        .join(heads.select(F.col("doc_id").alias("b")).distinct(), "b", "left_semi")
        .select("a", "b")
    )
    links = scratch.save(links.union(repeated), "links")
    components = connected_components(links, scratch, "first")
    crossing = _crossing(members.select("key", "doc_id"), heads, components, scratch, percent)
    more = _confirmed(crossing, docs, scratch, "cross", shingle_words, percent)
    if more.limit(1).count():
        components = connected_components(links.union(more), scratch, "second")
    of_class = scratch.save(
        classes.join(components, F.col("first") == F.col("doc_id"), "left").select(
            "digest", F.coalesce("component_id", "first").alias("component_id")
        ),
        "of_class",
    )
    out = sketches.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    return out.select("doc_id", "n_shingles", "digest", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
