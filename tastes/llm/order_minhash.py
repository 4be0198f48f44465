"""Document fingerprints by Order MinHash, with DataFrame functions only.

A text becomes pieces (runs of up to four characters other than ASCII blanks,
starting anew at each word), the pieces become k-mers, and every k-mer gets
the number of its occurrence in the text, so that a repeat counts. Each of the
signature's `size` components selects the `tuple_size` minimal numbered
k-mers of an order of its own, puts them back into text order and hashes the
tuple: two texts agree on a component if they share its k-mers in the same
order, which falls with edits and moves alike, not only with lost words.

The orders are the `size` rotations of one random order (a 64-bit hash): order
number j begins at the hash j * 2^64 / size and goes round. Every rotation is a
random order in itself, so the share of equal components is unbiased, and one
sort serves all of them: the rotations' starts are sorted in as marks, and the
selected k-mers are those that follow a mark. That is n log n work for a text
of n pieces instead of `size` passes over it.

Each array is computed once: a one-element `explode` between the steps keeps
Catalyst from copying a step's expression into the lambda of the next one,
where it would run once an element.

`fingerprint_edits` compares every document with an edited text of its own and
with the next document. One shuffle by document key carries the texts, both
sides of the join read it; the next document comes from a range partitioning of
the bare keys, written once so that a lost executor cannot move its borders.

Defined results: null text counts as empty; a text without pieces has no
components, an empty fingerprint and likeness 1 to another such text, 0 to any
other; a text with fewer pieces than a k-mer takes is one k-mer, one with fewer
k-mers than a tuple takes uses all of them; white space does not matter. Very
long texts are one row each, n log n. Rows that repeat both id and text are one
document, returned once for each row; rows that repeat an id with other texts
are documents of their own, in order of a hash of the text; rows without an id
come after all others. An empty table gives an empty result. Other columns of
the table are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, free_name

# Fixed value: a piece of text, up to four characters that are no blanks.
PIECE_PATTERN = r"[^\x20\x09-\x0D]{1,4}"

KMER = 3
TUPLE_SIZE = 2
SIZE = 64

# Rows of one chunk when a repeated document is returned once for each row.
COPIES_CHUNK = 4096


def _step(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """`df` with a column that is computed once a row, never inlined."""
    return df.select("*", F.explode(F.array(expression)).alias(name))


def _sorted(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Like `_step`, sorted; a projection sorts the numbers as compiled code."""
    plain = free_name(name, [*df.columns, name])
    return _step(df.withColumn(plain, F.sort_array(F.expr(expression))), name, F.col(plain)).drop(plain)


def with_signature(
    df: DataFrame,
    text: str,
    out: str,
    kmer: int = KMER,
    tuple_size: int = TUPLE_SIZE,
    size: int = SIZE,
) -> DataFrame:
    """`df` with `out`, the Order MinHash of column `text` (array of int)."""
    kept = df.columns
    pieces, hashes, bits, low, packed, starts, number, order, kmers, chosen = (
        free_name(n, kept)
        for n in (
            "pieces", "hashes", "bits", "low", "packed", "starts", "number", "order", "kmers", "chosen"
        )
    )
    texts = F.coalesce(F.col(text), F.lit(""))
    df = _step(df, pieces, F.regexp_extract_all(texts, F.lit(PIECE_PATTERN), F.lit(0)))

    # A k-mer's hash; past the end `get` is null, which the hash skips.
    one = ", ".join(f"get({pieces}, i + {j})" for j in range(kmer))
    df = _step(
        df,
        hashes,
        F.expr(
            f"case when size({pieces}) = 0 then cast(array() as array<bigint>) else "
            f"transform(sequence(0, greatest(size({pieces}) - {kmer}, 0)), i -> xxhash64({one})) end"
        ),
    ).drop(pieces)

    # Sorted by hash, then place: the low `bits` hold the place, and no place
    # has all of them set.
    df = _step(df, bits, F.length(F.bin(F.size(hashes))))
    df = _step(df, low, F.expr(f"shiftleft(1L, {bits}) - 1"))
    df = _sorted(df, packed, f"transform({hashes}, (h, i) -> shiftleft(h, {bits}) | cast(i as bigint))")
    df = _step(
        df,
        starts,
        F.expr(
            f"filter(sequence(0, greatest(size({packed}) - 1, 0)), i -> i = 0 or "
            f"shiftright({packed}[i], {bits}) != shiftright({packed}[i - 1], {bits}))"
        ),
    )
    # The number of each occurrence; without any repeat all are first.
    df = _step(
        df,
        number,
        F.expr(
            f"case when size({starts}) >= size({packed}) then cast(array() as array<int>) else "
            f"flatten(transform({starts}, (s, j) -> "
            f"sequence(0, coalesce(get({starts}, j + 1), size({packed})) - s - 1))) end"
        ),
    ).drop(starts)

    # The random order of the numbered k-mers, places in the low bits, and a
    # mark (all low bits set) where each rotation begins.
    marks = ", ".join(f"{-(2**63) + 1 + j * (2**64 // size) - 1}L" if j else "(-9223372036854775807L - 1)" for j in range(size))
    numbered = (
        f"transform({packed}, (x, i) -> "
        f"(x & {low}) | (~{low} & xxhash64({hashes}[cast(x & {low} as int)], {{}})))"
    )
    df = _sorted(
        df,
        order,
        f"concat(case when size({number}) = 0 then {numbered.format('0')} "
        f"else {numbered.format(f'{number}[i]')} end, transform(array({marks}), x -> x | {low}))",
    ).drop(packed, number)
    df = _step(df, kmers, F.expr(f"filter({order}, x -> (x & {low}) != {low})"))
    df = _step(
        df,
        starts,
        F.expr(f"filter(sequence(0, size({order}) - 1), i -> ({order}[i] & {low}) = {low})"),
    ).drop(order, hashes)

    # Each rotation's first k-mers, as place (high) and hash (low), then back in
    # text order. A text with fewer k-mers than a tuple takes repeats them.
    slot = f"cast(s div {tuple_size} as int)"
    df = _step(
        df,
        chosen,
        F.expr(
            f"case when size({kmers}) = 0 then cast(array() as array<bigint>) else "
            f"transform(transform(sequence(0, {size * tuple_size - 1}), "
            f"s -> {kmers}[({starts}[{slot}] - {slot} + s % {tuple_size}) % size({kmers})]), "
            f"x -> shiftleft(x & {low}, 32) | shiftrightunsigned(x, 32)) end"
        ),
    ).drop(kmers, starts)
    signature = F.expr(
        f"case when size({chosen}) = 0 then cast(array() as array<int>) else "
        f"transform(sequence(0, {size - 1}), j -> cast(shiftright(xxhash64(transform("
        f"sort_array(slice({chosen}, j * {tuple_size} + 1, {tuple_size})), "
        f"y -> y & 4294967295L)), 32) as int)) end"
    )
    return _step(df, out, signature).select(*(f"`{c}`" for c in kept), out)


def likeness(a: str, b: str) -> Column:
    """The share of equal components of two signatures, 0 to 1."""
    equal = F.expr(f"size(filter(sequence(0, size({a}) - 1), i -> {a}[i] = {b}[i]))")
    return (
        F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double"))
        .otherwise(equal / F.size(a))
    )


def as_text(signature: str) -> Column:
    """A signature as hexadecimal digits, eight a component."""
    return F.array_join(
        F.transform(signature, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")),
        "",
    )


def next_documents(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, next_key) of distinct (key, doc_id, text_hash) rows by descending id.

    The keys are range partitioned and written once. In a partition the next
    key is a window's; only the partitions' borders, one row each, meet in one
    task. After the last key comes the first.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash").asc(), F.col("key").asc()]
    placed = scratch.save(
        keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order"
    )
    rows = placed.select(
        "key", "part", F.lead("key").over(Window.partitionBy("part").orderBy(*order)).alias("inside")
    )
    firsts = placed.withColumn(
        "n", F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ).where("n = 1").select("part", "key")
    by_part = Window.orderBy("part")
    borders = firsts.select(
        "part",
        F.coalesce(
            F.lead("key").over(by_part),
            F.first("key").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("border"),
    )
    return rows.join(borders, "part").select("key", F.coalesce("inside", "border").alias("next_key"))


def fingerprint_edits(
    docs: DataFrame, kmer: int = KMER, tuple_size: int = TUPLE_SIZE, size: int = SIZE
) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses.

    The edited text replaces the last third (rounded down) of a text's code
    points by the first as many, or all, of the next document's by descending
    id. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, next_doc_id.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "order-minhash")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text_hash = F.xxhash64("text")
    # Never null, so that all joins are on one plain column.
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(text_hash))

    keys = (
        texts.select(key.alias("key"), "doc_id", text_hash.alias("text_hash"), F.length("text").alias("n"))
        .groupBy("key", "doc_id", "text_hash", "n")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    links = scratch.save(
        next_documents(keys, scratch)
        .join(keys.select("key", "copies", (F.col("n") / 3).cast("int").alias("wanted")), "key"),
        "links",
    )

    # One row a document; both joins read the one exchange below this aggregation.
    signed = with_signature(texts.withColumn("key", key), "text", "signature", kmer, tuple_size, size)
    by_key = signed.groupBy("key").agg(F.first(F.struct("doc_id", "text", "signature")).alias("own"))
    following = by_key.select(F.col("key").alias("next_key"), F.col("own").alias("next"))
    heads = links.join(following, "next_key").select(
        "key",
        "wanted",
        "copies",
        F.col("next.doc_id").alias("next_doc_id"),
        F.expr("substr(next.text, 1, wanted)").alias("head"),
        F.col("next.signature").alias("next_signature"),
    )
    edited = by_key.join(heads, "key").select("own.*", *heads.columns[1:])
    n = F.length("text")
    edited = edited.withColumn(
        "edited", F.concat(F.expr("substr(text, 1, length(text) - wanted)"), "head")
    )
    edited = edited.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "edited",
        "signature",
        "next_signature",
        "next_doc_id",
        "copies",
    )
    edited = with_signature(edited, "edited", "edited_signature", kmer, tuple_size, size)
    result = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("signature").alias("fingerprint"),
        as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
        "next_doc_id",
        "copies",
    )
    chunks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_CHUNK))
    return (
        result.withColumn("chunk", F.explode(chunks))
        .withColumn(
            "copy",
            F.explode(
                F.sequence(
                    F.lit(1), F.least(F.lit(COPIES_CHUNK), F.col("copies") - F.col("chunk") * COPIES_CHUNK)
                )
            ),
        )
        .drop("chunk", "copy", "copies")
    )
