"""Document fingerprints by a homomorphic multiset hash, in DataFrame expressions alone.

A text is a multiset of paragraphs, and long paragraphs fall into pieces at bounds that
their own letters set. Each piece is hashed to a wide vector; a fingerprint is the sum of
the vectors modulo powers of two. So order does not matter, and pieces are added or
removed by adding or subtracting their vectors.

The vector has two parts: four 60-bit hashes, whose sums tell different multisets apart,
and 64 single bits, whose sums (how many pieces have the bit) keep likeness: pieces that
two texts share pull their bit counts the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, table

MASK = (1 << 60) - 1
LANE = 20  # bits of a lane; three lanes in a long
LANES = 22  # longs that hold 64 lanes
STRONG = 4
SEED = 11
# A piece ends at a line break, or at white space after a sentence mark or a letter of this class.
PIECE_END = r"[\n\r]+|(?<=[.,;:!?|nsrx])[\t ]+"
RANGE_ROWS = 20_000


def pieces(text: Column) -> Column:
    """The pieces of a text, blank ones left out; a text without any has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), PIECE_END), lambda p: F.length(F.trim(p)) > 0)


def with_vector(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` and the vector of a text: 4 strong sums, 22 longs of three 20-bit lanes (bit counts), the number of pieces.

    The hashes are columns of their own, so that a text is divided once and not once per sum.
    """
    two = df.withColumn("__pieces", pieces(text))
    two = two.withColumn("__first", F.transform("__pieces", lambda p: F.xxhash64(p))).withColumn("__second", F.transform("__pieces", lambda p: F.xxhash64(p, F.lit(SEED))))
    first, second = F.col("__first"), F.col("__second")
    strong = [first, second, F.transform(first, lambda h: F.xxhash64(h)), F.transform(second, lambda h: F.xxhash64(h))]
    sums = [_modular_sum(values, lambda h: h.bitwiseAND(F.lit(MASK))) for values in strong]
    sums += [_modular_sum(first, _three_bits(k)) for k in range(LANES)]
    return two.withColumn(name, F.array(*sums, F.size(first).cast("long"))).drop("__pieces", "__first", "__second")


def _modular_sum(values: Column, part: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: (total + part(x)).bitwiseAND(F.lit(MASK)))


def _three_bits(k: int) -> Callable[[Column], Column]:
    """Bits k, k + 22 and k + 44 of a hash, each in its lane."""

    def bits(h: Column) -> Column:
        out = F.shiftrightunsigned(h, k).bitwiseAND(F.lit(1))
        for lane in (1, 2):
            if k + LANES * lane < 64:
                out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(h, k + LANES * lane).bitwiseAND(F.lit(1)), LANE * lane))
        return out

    return bits


def add_vectors(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def subtract_vectors(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` after its pieces ``b`` have been taken out."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def fingerprint_text(vector: Column) -> Column:
    """Fixed-width lower-case hex of a vector; equal vectors, equal strings."""
    return F.array_join(F.transform(vector, lambda x: F.lower(F.lpad(F.hex(x), 15, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the signed bit sums (pieces with a bit minus pieces without it), 1 for equal vectors, 0 if one is empty.

    Its expectation is the share of pieces in common (for multisets, their cosine); 64
    signs give it a spread of about 1/8. A lane holds up to 2**20 pieces.
    """
    signed = lambda v: [
        (F.shiftrightunsigned(v[STRONG + k], LANE * lane).bitwiseAND(F.lit((1 << LANE) - 1)) * 2 - v[STRONG + LANES]).cast("double")
        for lane in range(3)
        for k in range(LANES)
        if k + LANES * lane < 64
    ]
    x, y = F.array(*signed(a)), F.array(*signed(b))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, e: s + e)
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    size = F.sqrt(total(F.transform(x, lambda p: p * p))) * F.sqrt(total(F.transform(y, lambda p: p * p)))
    cosine = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / size))).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def fingerprint(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns and ``fingerprint``; an own column of that name is replaced.

    One pass over whole texts without a shuffle. NULL and empty texts have the fingerprint
    of no pieces. Texts with the same pieces in any order share a fingerprint.
    """
    return with_vector(docs, F.col(text_column), "__vector").withColumn("fingerprint", fingerprint_text(F.col("__vector"))).drop("__vector")


def next_rows(keys: DataFrame) -> DataFrame:
    """For distinct (doc_id, sha), other columns kept: also next_id, next_sha of the row that follows by descending id and sha, after the last the first.

    Keys are range-partitioned and written with the number of their range. Inside a range a
    window finds the next key; of each range only its first key is looked at by the others.
    """
    parts = max(1, -(-keys.count() // RANGE_ROWS))
    order = [F.col("doc_id").desc_nulls_last(), F.col("sha").desc()]
    ranged = cut(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    inside = W.partitionBy("part").orderBy(*order)
    linked = ranged.withColumn("next", F.lead(F.struct("doc_id", "sha")).over(inside)).withColumn("place", F.row_number().over(inside))
    heads = linked.where("place = 1").select("part", F.struct("doc_id", "sha").alias("head"))
    # one row per range of RANGE_ROWS keys
    over = W.orderBy("part")
    first = F.first("head").over(over.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    heads = cut(heads.select("part", F.coalesce(F.lead("head").over(over), first).alias("after")), "range-heads")
    joined = linked.join(heads, "part")
    following = F.coalesce("next", "after")
    return joined.select(*keys.columns, following["doc_id"].alias("next_id"), following["sha"].alias("next_sha"))


def compare_with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likeness to that and to the next document.

    The edited text has its last half replaced by as much of the next document, by descending
    id; equal ids follow each other by their text's hash, NULL ids come last. NULL texts are
    empty. Repeated rows (equal id and text) are one document of the order and come back as
    often as they stand in the table. Texts meet by two joins on (id, hash), keys that no
    two documents share.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    keyed = rows.withColumn("sha", F.sha2("text", 256)).withColumn("n_chars", F.length("text").cast("long"))
    counted = cut(keyed.groupBy("doc_id", "sha", "n_chars").agg(F.count("*").alias("copies")), "document-keys")
    links = cut(next_rows(counted.select("doc_id", "sha", "n_chars")), "next-documents")
    repeated = counted.where("copies > 1").limit(1).count() > 0
    texts = keyed.dropDuplicates(["doc_id", "sha"]) if repeated else keyed
    made = with_vector(texts.select("doc_id", "sha", "text"), F.col("text"), "v")
    need = links.select("next_id", "next_sha", F.col("doc_id").alias("own_id"), F.col("sha").alias("own_sha"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    given = made.join(need, F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("sha") == F.col("next_sha")))
    given = given.select("own_id", "own_sha", F.substring(F.col("text"), F.lit(1), F.col("half")).alias("head"), F.col("v").alias("next_v"))
    both = made.join(given, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("sha") == F.col("own_sha")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.col("head"))
    changed = with_vector(both.withColumn("edited", edited), F.col("edited"), "e")
    result = changed.select(
        "doc_id", "sha", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("v")).alias("fingerprint"), fingerprint_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("e")).alias("near_edited"), likeness(F.col("v"), F.col("next_v")).alias("near_next"),
    )
    if not repeated:
        return result.drop("sha")
    again = counted.select(F.col("doc_id").alias("own_id"), F.col("sha").alias("own_sha"), "copies")
    many = result.join(again, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("sha") == F.col("own_sha")))
    return many.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("sha", "own_id", "own_sha", "copies", "copy")


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Per document: fingerprint, edited text's fingerprint, likenesses."""
    return compare_with_edits(table(spark, sf_dir, "documents"))
