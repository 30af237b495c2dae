"""Lines that earlier documents hold already, as one compressed keep bitmap per document.

A line's key is the line without ASCII white space at both ends, A-Z in lower case; keys of
at least ``least`` code points count. Keys held by two documents or more stay only in the
smallest document key that holds them, there in all their places. Documents are split at
``\\n``; a null or empty text is one empty line.

Hashes of 128 bits are dealt out by ranges over (hash, document, position), so the rows of
a line that a third of all documents hold lie in many partitions. Each task streams its
sorted rows: the first document of a run of equal hashes keeps its lines, later ones lose
theirs. The run that opens a partition may have begun in an earlier one, so its rows wait
for the first document of that hash over all partitions, which the partitions' edges tell.
Texts don't move to find this; only hashes, keys and positions do.

Equal rows get equal bitmaps. Rows that share a key are one document. A null key is one
document that comes after all others. An empty table gives no rows. Any number of lines and
any length of text is taken whole. Extra columns are not read.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.storage import landed

BLANK = " \t\n\x0b\x0c\r"
LEAST_CHARS = 10


def lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _identity(key: str, text: str) -> dict[str, Column]:
    """Two hashes that tell rows with different keys or texts apart."""
    return {"_a": F.xxhash64(F.lit(0), key, text), "_b": F.xxhash64(F.lit(1), text, key)}


def hashed_lines(docs: DataFrame, key: str, text: str, least: int = LEAST_CHARS) -> DataFrame:
    """``hi, lo`` (the line key's hash), ``doc``, ``_a, _b`` and ``position`` of every line that counts."""
    rows = docs.select(F.col(key).alias("doc"), *[c.alias(n) for n, c in _identity(key, text).items()], F.posexplode(lines(text)).alias("position", "_line"))
    stripped = F.translate(F.btrim("_line", F.lit(BLANK)), string.ascii_uppercase, string.ascii_lowercase)
    keyed = rows.withColumn("_key", stripped).where(F.length("_key") >= least)
    return keyed.select(F.xxhash64("_key").alias("hi"), F.xxhash64(F.lit(2), "_key").alias("lo"), "doc", "_a", "_b", "position")


def _codes(column: pa.Array) -> np.ndarray:
    """Small numbers that are equal where values are, nulls included."""
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted partition: lines to drop (no hash), rows that wait, and the edges (no position).

    An edge is the first or the last run's hash with the first document seen of it here.
    """
    run, holder, opening = None, None, True
    first_edge = None

    def out(batch, keep, with_hash):
        kept = batch.filter(pa.array(keep))
        columns = [kept.column(name) for name in ("hi", "lo", "doc")]
        if not with_hash:
            columns = [pa.nulls(len(kept), c.type) for c in columns]
        return pa.record_batch([*columns, kept.column("_a"), kept.column("_b"), kept.column("position")], names)

    names = ["hi", "lo", "doc", "_a", "_b", "position"]
    schema = None
    for batch in batches:
        schema = batch.schema
        n = len(batch)
        if not n:
            continue
        hi, lo, docs = (batch.column(name) for name in ("hi", "lo", "doc"))
        high, low = hi.to_numpy(), lo.to_numpy()
        new = np.ones(n, bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        new[0] = (int(high[0]), int(low[0])) != run
        first = first_edge is None
        if first:
            first_edge = (int(high[0]), int(low[0]), docs[0].as_py())
        starts = np.flatnonzero(new)
        # The run that goes on from the batch before has number -1 and its holder is known.
        number = np.cumsum(new) - 1
        codes = _codes(docs)
        known = _codes(pa.concat_arrays([pa.array([holder], docs.type), docs]))
        same = np.where(number < 0, known[1:] == known[0], codes == codes[starts[np.maximum(number, 0)]] if len(starts) else False)
        still = (number < 0) if opening and not first else (number == 0) if first else np.zeros(n, bool)
        opening = bool(still[-1])
        yield out(batch, ~still & ~same, False)
        yield out(batch, still, True)
        if len(starts):
            run, holder = (int(high[starts[-1]]), int(low[starts[-1]])), docs[int(starts[-1])].as_py()
    if first_edge is not None:
        edges = {first_edge, (*run, holder)}
        types = [schema.field(name).type for name in names]
        columns = [pa.array(values, t) for values, t in zip(zip(*edges), types)]
        yield pa.record_batch([*columns, *[pa.nulls(len(edges), t) for t in types[3:]]], names)


def dropped_lines(keyed: DataFrame) -> DataFrame:
    """``_a, _b, position`` of the lines that an earlier document holds."""
    order = [F.col("hi"), F.col("lo"), F.col("doc").asc_nulls_last(), F.col("_a"), F.col("_b"), F.col("position")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = landed(ranged.mapInArrow(_stream, ", ".join(f"{name} {kind}" for name, kind in keyed.dtypes)))
    certain = marked.where("hi is null").select("_a", "_b", "position")
    # Two edges per partition of the sorted rows at most, so they are shared with all tasks.
    edges = F.broadcast(marked.where("position is null").groupBy("hi", "lo").agg(F.min("doc").alias("_first")))
    waiting = marked.where("hi is not null and position is not null").join(edges, ["hi", "lo"])
    return certain.unionByName(waiting.where(~F.col("doc").eqNullSafe(F.col("_first"))).select("_a", "_b", "position"))


def pack_bits(n_lines: Column, dropped: Column) -> Column:
    """The keep bitmap, lowest bit first, compressed; null where no line is dropped."""

    @F.arrow_udf("binary")
    def pack(sizes: pa.Array, gone: pa.Array) -> pa.Array:
        found = []
        for size, places in zip(sizes.to_pylist(), gone):
            if not places.is_valid or not len(places.values):
                found.append(None)
                continue
            keep = np.ones(size, bool)
            keep[places.values.to_numpy()] = False
            found.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        return pa.array(found, pa.binary())

    return pack(n_lines, dropped)


def kept_text(text: Column, keep: Column) -> Column:
    """The lines whose bits are set, joined by ``\\n``."""

    @F.arrow_udf("string")
    def select(texts: pa.Array, bitmaps: pa.Array) -> pa.Array:
        found = []
        for value, bitmap in zip(texts, bitmaps):
            value = value.as_py() or ""
            if bitmap.is_valid:
                parts = value.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap.as_py()), np.uint8), count=len(parts), bitorder="little")
                value = "\n".join(parts[i] for i in np.flatnonzero(bits).tolist())
            found.append(value)
        return pa.array(found, pa.string())

    return select(text, keep)


def _with_drops(docs: DataFrame, key: str, text: str, least: int, columns: list[str]) -> DataFrame:
    rows = docs.select(*columns, F.size(lines(text)).cast("bigint").alias("n_lines"), *[c.alias(n) for n, c in _identity(key, text).items()])
    gone = dropped_lines(hashed_lines(docs, key, text, least)).groupBy("_a", "_b").agg(F.collect_set("position").alias("_gone"))
    found = rows.join(landed(gone), ["_a", "_b"], "left")
    dropped = F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped")
    return found.select(*columns, "n_lines", dropped, pack_bits(F.col("n_lines"), F.col("_gone")).alias("keep"))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """``key, n_lines, n_dropped, keep`` of every row; ``keep`` is null where every line stays."""
    return _with_drops(docs.select(key, text), key, text, least, [key])


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """The same with ``kept``, the text of the lines that stay."""
    found = _with_drops(docs.select(key, text), key, text, least, [key, text])
    return found.select(key, "n_lines", "n_dropped", "keep", kept_text(F.col(text), F.col("keep")).alias("kept"))
