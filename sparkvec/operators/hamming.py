"""Exact nearest neighbours of packed bit vectors: multi-index hashing.

Codes are cut into chunks of bits. Two codes that differ in at most r bits agree in at
least one of m chunks up to r // m bits, so the members within a distance are found by
looking up, for each chunk, all values within a few bits of the query's. The radius grows
round by round: round c looks up the values exactly c bits away, after which every member
within m * (c + 1) - 1 bits has been seen, and a query whose k-th hit lies within that is
done. A pair is looked at in one place only, the first of its most alike chunks.

Lookups are equi-joins on (chunk, value); equal codes are one row with their k lowest
keys, so copies cost one row. A pair that is looked up costs as much as some thousand that
are compared in a block: each round's pairs are counted first, from the numbers of queries
and codes of each value, and when they would cost more, the queries that are still open
meet all codes in blocks instead, and the answer is the same. Only the numbers of open
queries, of codes and of a round's pairs reach the driver.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions.codec import bit_words
from ..functions.predicates import where
from ..session import settle
from .knn_join import REPEATED
from .tiles import LEAST_ROWS, TILES, arrow_schema

#: Bits of a chunk: for few codes, and from so many codes on.
NARROW, WIDE, MANY = 8, 16, 1 << 14
#: Codes or queries of a block at most, and that are compared at a time.
BLOCK, QUERIES, CODES = 1 << 16, 1 << 7, 1 << 11
#: Pairs compared in a block in the time that one takes to be looked up.
LOOKUP = 5000


def _width(df: DataFrame, field: str) -> int:
    """The size in bytes that most vectors have, the smaller of two."""
    sizes = df.where(F.col(field).isNotNull()).groupBy(F.octet_length(field).alias("n")).agg(F.count("*").alias("rows"))
    row = sizes.orderBy(F.desc("rows"), "n").first()
    return row["n"] if row else 0


def _chunk(words: Column, j: int, bits: int) -> Column:
    """Chunk j of an array of 64-bit words, as a number."""
    at = j * bits
    return F.shiftrightunsigned(words[at // 64], 64 - bits - at % 64).bitwiseAND(F.lit((1 << bits) - 1))


def _asked(queries: DataFrame, qid: str, field: str, width: int) -> DataFrame:
    """``(qid, words)``, one row per id; an id may be repeated with the same vector only."""
    sound = queries.select(F.col(qid).alias("qid"), F.col(field).alias("v")).where(F.col("qid").isNotNull() & (F.octet_length("v") == width))
    folded = sound.groupBy("qid").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    one = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.lit(REPEATED)))
    return folded.select("qid", bit_words(one).alias("words"))


def _classes(members: DataFrame, k: int) -> DataFrame:
    """``(words, pks)``: each code with its k lowest keys."""
    # A group limit: of a code with very many copies each task sends k rows.
    place = F.row_number().over(Window.partitionBy("words").orderBy("pk"))
    lowest = members.withColumn("n", place).where(F.col("n") <= k)
    return lowest.groupBy("words").agg(F.sort_array(F.collect_list("pk")).alias("pks"))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("d", "pk")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hamming_join(
    queries: DataFrame,
    df: DataFrame,
    *,
    qid: str,
    pk: str,
    field: str,
    query_field: str | None = None,
    k: int = 10,
    filter: str | Column | None = None,
    radius: float | None = None,
) -> DataFrame:
    """Rows ``(qid, rank, pk, score)``: the k nearest of ``df`` for each query, ties by key.

    ``field`` is a packed bit vector (binary). The score is the root of the number of
    differing bits, ``radius`` the largest one to return. Vectors that are null or of
    another size than most in ``df`` have no score.
    """
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise InvalidArgument("top_k must be a positive integer")
    width = _width(df, field)
    members = where(df, filter).where(F.octet_length(field) == width).select(F.col(pk).alias("pk"), bit_words(F.col(field)).alias("words"))
    classes = settle(_classes(members.where("pk is not null"), k))
    open_ = settle(_asked(queries, qid, query_field or field, width))
    codes = classes.count()
    bits = WIDE if codes >= MANY else NARROW
    chunks = -(-8 * width // bits)
    listed = classes.select("words", "pks", F.posexplode(F.array(*(_chunk(F.col("words"), j, bits) for j in range(chunks)))).alias("j", "value"))

    best, seen, left = None, False, open_.count() if codes else 0
    for away in range(bits + 1) if codes else ():
        turned = chunks * math.comb(bits, away)
        # What even chunks would meet, and then what these do.
        if turned > (1 << bits) // 2 or turned * LOOKUP > 1 << bits or _pairs(open_, listed, away, bits, chunks) * LOOKUP > left * codes:
            break
        found = _looked_up(open_, listed, away, bits, chunks, k)
        # A query's earlier hits go on with it.
        found = found if best is None else found.unionByName(best)
        best = settle(_ranked(found, k).drop("rank"))
        full = best.groupBy("qid").agg(F.count("*").alias("n"), F.max("d").alias("d"))
        done = full.where((F.col("n") >= k) & (F.col("d") < chunks * (away + 1))).select("qid")
        open_ = settle(open_.join(done, "qid", "left_anti"))
        # Beyond all bits of a chunk there is nothing left to look up.
        left = open_.count()
        seen = away == bits or not left
        if seen:
            break
    if left and not seen:
        scanned = _scanned(open_, classes, codes, left, k)
        best = scanned if best is None else best.join(open_.select("qid"), "qid", "left_anti").unionByName(scanned)
    if best is None:
        none = T.StructType([open_.schema["qid"], members.schema["pk"], T.StructField("d", T.IntegerType())])
        best = df.sparkSession.createDataFrame([], none)
    ranked = _ranked(best, k).select("qid", "rank", "pk", F.sqrt(F.col("d").cast("double")).alias("score"))
    return ranked if radius is None else ranked.where(F.col("score") <= radius)


def _masks(away: int, bits: int) -> Column:
    """A row for each number with ``away`` of ``bits`` bits."""
    masks = ",".join(str(sum(1 << b for b in picked)) for picked in itertools.combinations(range(bits), away))
    return F.explode(F.split(F.lit(masks), ",").cast("array<bigint>"))


def _pairs(open_: DataFrame, listed: DataFrame, away: int, bits: int, chunks: int) -> int:
    """The number of pairs that a round looks at."""
    values = F.posexplode(F.array(*(_chunk(F.col("words"), j, bits) for j in range(chunks))))
    asked = open_.select(values.alias("j", "own")).groupBy("j", "own").agg(F.count("*").alias("asked"))
    asked = asked.select("j", "asked", "own", _masks(away, bits).alias("mask")).withColumn("value", F.col("own").bitwiseXOR(F.col("mask")))
    met = asked.join(listed.groupBy("j", "value").agg(F.count("*").alias("known")), ["j", "value"])
    return met.agg(F.sum(F.col("asked") * F.col("known")).alias("n")).first()["n"] or 0


def _looked_up(open_: DataFrame, listed: DataFrame, away: int, bits: int, chunks: int, k: int) -> DataFrame:
    """``(qid, pk, d)``: the k nearest of each query among codes with a chunk exactly ``away`` bits off."""
    values = F.posexplode(F.array(*(_chunk(F.col("words"), j, bits) for j in range(chunks))))
    probes = open_.select("qid", F.col("words").alias("asked"), values.alias("j", "own")).select("qid", "asked", "j", "own", _masks(away, bits).alias("mask"))
    probes = probes.select("qid", "asked", "j", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
    met = probes.join(listed, ["j", "value"])
    apart = F.array(*(F.bit_count(_chunk(F.col("words"), j, bits).bitwiseXOR(_chunk(F.col("asked"), j, bits))) for j in range(chunks)))
    met = met.select("qid", "pks", "j", apart.alias("apart"))
    # The pair's own place: the first of its chunks with the fewest differing bits.
    here = (F.array_min("apart") == away) & (F.array_position("apart", F.lit(away)) == F.col("j") + 1)
    sums = F.aggregate("apart", F.lit(0), lambda s, x: s + x)
    return _ranked(met.where(here).select("qid", F.explode("pks").alias("pk"), sums.alias("d")), k).drop("rank")


def nearest_codes(asked: np.ndarray, codes: np.ndarray, lowest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, code, bits apart)``: the k nearest codes of each query, ties by the codes' order in ``lowest``.

    A cache's worth of pairs at a time. Codes come in the order of their keys, so once a
    query has k hits only a nearer code can be one.
    """
    order = np.argsort(lowest, kind="stable")
    words = np.ascontiguousarray(codes[order].T)
    small = codes.shape[1] == 1
    out = []
    for at in range(0, len(asked), QUERIES):
        part = np.ascontiguousarray(asked[at : at + QUERIES].T)[:, :, None]
        n = part.shape[1]
        worst = np.full(n, -1, np.int64)
        held, fresh, n_fresh = (np.empty(0, np.int64),) * 3, [], 0

        def merged():
            query, code, apart = (np.concatenate(x) for x in zip(held, *fresh, strict=True))
            by = np.lexsort((code, apart, query))
            query = query[by]
            first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else by
            place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
            query, code, apart, place = (x[place < k] for x in (query, code[by], apart[by], place))
            last = place == k - 1
            worst[query[last]] = apart[last]
            return query, code, apart

        for a in range(0, len(order), CODES):
            block = words[:, a : a + CODES]
            apart = np.bitwise_count(part[0] ^ block[0])
            if not small:
                apart = apart.astype(np.int32)
                for w in range(1, len(words)):
                    apart += np.bitwise_count(part[w] ^ block[w])
            full = worst >= 0
            if full.all():
                near = apart < worst.astype(apart.dtype)[:, None]
            else:
                cut = worst - 1
                cut[~full] = np.iinfo(apart.dtype).max if block.shape[1] <= k else np.partition(apart[~full], k - 1, axis=1)[:, k - 1]
                # Of a query without k hits all may count; below nothing is none.
                near = (apart <= np.maximum(cut, 0).astype(apart.dtype)[:, None]) & (cut >= 0)[:, None]
            hit = np.flatnonzero(near)
            if len(hit):
                fresh.append((hit // block.shape[1], a + hit % block.shape[1], apart.ravel()[hit].astype(np.int64)))
                n_fresh += len(hit)
                if n_fresh > 2 * n or not full.all():
                    held, fresh, n_fresh = merged(), [], 0
        query, code, apart = merged()
        out.append((query + at, order[code], apart))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _scanned(open_: DataFrame, classes: DataFrame, codes: int, left: int, k: int) -> DataFrame:
    """``(qid, pk, d)``: the k nearest of each query among all codes, block by block."""
    side = math.ceil(math.sqrt(TILES * open_.sparkSession.sparkContext.defaultParallelism))
    of_codes, of_queries = (-(-n // min(BLOCK, max(LEAST_ROWS, -(-n // side)))) for n in (codes, left))

    def dealt(side: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int").alias(own)
        return side.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    asked = dealt(open_.withColumnRenamed("words", "asked"), "qid", "qb", of_queries, "cb", of_codes)
    known = dealt(classes, "words", "cb", of_codes, "qb", of_queries)
    schema = T.StructType([open_.schema["qid"], classes.schema["pks"], T.StructField("d", T.IntegerType())])
    out = arrow_schema(schema)

    def words(column: pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).view(np.uint64)

    def tile(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return out.empty_table()
        pks = c["pks"].combine_chunks()
        lowest = pks.flatten().take(pa.array(pks.offsets.to_numpy()[:-1] - pks.offsets[0].as_py())).to_numpy(zero_copy_only=False)
        query, code, apart = nearest_codes(words(q["asked"]), words(c["words"]), lowest, k)
        columns = [q["qid"].combine_chunks().take(pa.array(query)), pks.take(pa.array(code)), pa.array(apart, pa.int32())]
        return pa.Table.from_arrays([x.cast(f.type) for x, f in zip(columns, out, strict=True)], schema=out)

    found = asked.groupBy("qb", "cb").cogroup(known.groupBy("qb", "cb")).applyInArrow(tile, schema)
    return _ranked(found.select("qid", F.explode("pks").alias("pk"), "d"), k).drop("rank")
