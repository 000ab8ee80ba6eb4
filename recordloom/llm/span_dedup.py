"""Removal of byte spans that occur earlier in the corpus, exact for every span of a given length or more.

The corpus is not sorted as a whole. Content-chosen anchors (``anchors``) bring together only places that can be equal,
with a hash of all that the anchor's windows cover, its context. Places whose context came before are removed at
once. Only where the same anchor has different contexts are the bytes looked at: the first place of each such context
goes into an enhanced suffix array with the others of its anchor, and of every maximal repeat all places but the
earliest are removed. An anchor with very many contexts is compared by the hashes of its windows instead, a row each,
so that no task holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.anchors import anchors, window_hashes
from recordloom.llm.suffix_repeats import maximal_repeats
from recordloom.llm.tables import by_batches, by_runs, written

#: Bytes of an anchor's gram.
GRAM = 32
#: Contexts whose suffixes are put in order at once; they take some hundred bytes of memory for each of their bytes.
CONTEXT_ROWS = 3_000
#: Bytes of text for a partition of anchors, about; they take some 50 MB.
BUCKET_BYTES = 48 << 20
#: An anchor with more contexts than this is compared window by window.
MANY_CONTEXTS = 20_000
_U = np.uint64
_NO_ID = np.iinfo(np.int64).min

_FOUND = "doc long, tie long, kind int, data binary"
_SPAN, _REQUEST, _MANY, _TEXT = 0, 1, 2, -1


def _keys(docs: DataFrame, id_column: str, text_column: str, seed: int) -> DataFrame:
    """(doc, tie, text): the order of documents is that of ids, then of a 64-bit hash of the text; a null id comes first."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    doc = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_NO_ID))
    return docs.select(doc.alias("doc"), F.xxhash64(text, F.lit(seed)).alias("tie"), text.alias("text"))


def _grouped(doc: np.ndarray, tie: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """For each document the bytes of its rows of ``columns``, one column after the other."""
    order = np.lexsort((columns[0], tie, doc))
    doc, tie, columns = doc[order], tie[order], [c[order] for c in columns]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]), True]) if len(doc) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(doc[a]), int(tie[a]), b"".join(c[a:b].tobytes() for c in columns)


def _spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """For each document its spans, united, as starts and ends of 32 bits."""
    if not len(doc):
        return
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    owner = np.cumsum(np.r_[0, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])])
    far = np.maximum.accumulate(end + owner * (1 << 33)) - owner * (1 << 33)
    new = np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] > far[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(doc) - 1]
    yield from _grouped(doc[first], tie[first], [start[first].astype(np.int32), far[last].astype(np.int32)])


def _batch(rows: list[tuple], kind: int, bucket: np.ndarray | None = None) -> pa.RecordBatch:
    doc, tie, data = (list(x) for x in zip(*rows)) if rows else ([], [], [])
    columns = [pa.array(doc, pa.int64()), pa.array(tie, pa.int64()), pa.array([kind] * len(doc), pa.int32()), pa.array(data, pa.binary())]
    names = ["doc", "tie", "kind", "data"]
    if bucket is not None:
        columns, names = [pa.array(bucket, pa.int32()), *columns], ["bucket", *names]
    return pa.RecordBatch.from_arrays(columns, names)


_RECORD = np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("low", "<i4"), ("end", "<i4")])


def _first_and_later(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records sorted by gram, context and place, and which of them are not the first of their context."""
    found = found[np.lexsort((found["low"], found["tie"], found["doc"], found["context"], found["gram"]))]
    later = np.zeros(len(found), bool)
    later[1:] = (found["gram"][1:] == found["gram"][:-1]) & (found["context"][1:] == found["context"][:-1])
    return found, later


def _anchor_rows(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column(2)):
                doc = np.asarray(batch.column(0))[texts.first : texts.first + len(texts)]
                tie = np.asarray(batch.column(1))[texts.first : texts.first + len(texts)]
                own = anchors(texts.data, texts.offsets, length, GRAM)
                if not len(own.at):
                    continue
                hashes = window_hashes(texts.data, length)
                of = np.searchsorted(texts.offsets, own.low, "right") - 1
                found = np.empty(len(of), _RECORD)
                found["gram"] = own.gram
                place = (own.at - own.low) * (length + 1) + own.high - own.at
                found["context"] = words.mix(hashes[own.low] + words.mix(hashes[own.high] + place.astype(_U)))
                found["doc"], found["tie"] = doc[of], tie[of]
                found["low"] = own.low - texts.offsets[of]
                found["end"] = own.high + length - texts.offsets[of]
                found, later = _first_and_later(found)
                gone, found = found[later], found[~later]
                spans = list(_spans(gone["doc"], gone["tie"], gone["low"].astype(np.int64), gone["end"].astype(np.int64)))
                yield _batch(spans, _SPAN, np.array([d % buckets for d, _, _ in spans], np.int32))
                bucket = (found["gram"] >> _U(20)) % _U(buckets)
                found = found[np.argsort(bucket, kind="stable")]
                bucket = np.sort(bucket)
                cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
                blobs = [(0, 0, b"".join(np.ascontiguousarray(found[name][a:b]).tobytes() for name in _RECORD.names)) for a, b in zip(cut[:-1], cut[1:])]
                yield _batch(blobs, _REQUEST, bucket[cut[:-1]].astype(np.int32))

    return rows.mapInArrow(run, "bucket int, " + _FOUND)


def _records(blob: bytes) -> np.ndarray:
    n = len(blob) // _RECORD.itemsize
    out, at = np.empty(n, _RECORD), 0
    for name in _RECORD.names:
        kind = _RECORD[name]
        out[name] = np.frombuffer(blob, kind, n, at)
        at += n * kind.itemsize
    return out


def _compare_contexts(sent: DataFrame) -> DataFrame:
    """Spans whose context came before, and requests for the bytes of contexts that their gram does not decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        of = None

        def compared() -> Iterator[pa.RecordBatch]:
            found, later = _first_and_later(np.concatenate(held))
            gone, found = found[later], found[~later]
            yield _batch(list(_spans(gone["doc"], gone["tie"], gone["low"].astype(np.int64), gone["end"].astype(np.int64))), _SPAN)
            gram = found["gram"]
            starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
            count = np.diff(np.r_[starts, len(gram)])
            each = np.repeat(count, count)
            for kind, part in ((_REQUEST, found[(each > 1) & (each <= MANY_CONTEXTS)]), (_MANY, found[each > MANY_CONTEXTS])):
                yield _batch(list(_grouped(part["doc"], part["tie"], [part["low"], part["end"], part["gram"]])), kind)

        for batch in batches:
            spans = batch.filter(pc.equal(batch.column(3), _SPAN))
            yield spans.select(["doc", "tie", "kind", "data"])
            blobs = batch.filter(pc.equal(batch.column(3), _REQUEST))
            for bucket, blob in zip(blobs.column(0).to_pylist(), blobs.column(4).to_pylist()):
                if bucket != of and held:
                    yield from compared()
                    held = []
                of = bucket
                held.append(_records(blob))
        if held:
            yield from compared()

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _FOUND)


def _packed_texts(rows: DataFrame) -> DataFrame:
    """Texts as rows of the form of ``found``, compressed for the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_TEXT] * len(texts), pa.int32()), pa.array(map(pack, texts), pa.binary())],
                ["doc", "tie", "kind", "data"],
            )

    return by_batches(rows, run, _FOUND)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, int, list[tuple[int, bytes]]]]:
    """Of rows sorted by document and kind: each document once, its text, how often it is there, and its other rows."""
    unpack = zstandard.ZstdDecompressor().decompress
    own: tuple | None = None
    text, times, rest = b"", 0, []
    for batch in batches:
        for doc, tie, kind, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if (doc, tie) != own:
                if own is not None:
                    yield (*own, text, times, rest)
                own, text, times, rest = (doc, tie), b"", 0, []
            if kind == _TEXT:
                own_text = unpack(data)
                if times and own_text != text:
                    raise ValueError(f"Two texts of the id {doc} have the same hash; give another seed.")
                text, times = own_text, times + 1
            else:
                rest.append((kind, data))
    if own is not None:
        yield (*own, text, times, rest)


def _with_texts(texts: DataFrame, found: DataFrame) -> DataFrame:
    return texts.unionByName(found).repartition("doc", "tie").sortWithinPartitions("doc", "tie", "kind")


def _requested_bytes(texts: DataFrame, requests: DataFrame, length: int) -> DataFrame:
    """The contexts asked for, by their gram; of grams with many contexts, the hash of each window as ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*rows)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "many", "doc", "tie", "low", "data"])

        for doc, tie, text, _, rest in _documents(batches):
            for kind, data in rest:
                n = len(data) // 16
                low, end = np.frombuffer(data, "<i4", n).tolist(), np.frombuffer(data, "<i4", n, 4 * n).tolist()
                gram = np.frombuffer(data, "<i8", n, 8 * n).tolist()
                for a, b, g in zip(low, end, gram):
                    if kind == _REQUEST:
                        rows.append((g, 0, doc, tie, a, text[a:b]))
                    else:
                        keys = window_hashes(np.frombuffer(text[a:b], np.uint8), length).view(np.int64).tolist()
                        rows += [(k, 1, doc, tie, a + i, None) for i, k in enumerate(keys)]
            if len(rows) > 20_000:
                yield batch()
                rows = []
        yield batch()

    return _with_texts(texts, requests).mapInArrow(run, "key long, many int, doc long, tie long, low int, data binary")


def _earliest(doc: np.ndarray, tie: np.ndarray, low: np.ndarray) -> int:
    return int(np.lexsort((low, tie, doc))[0])


def _repeats_of_contexts(asked: DataFrame, length: int) -> DataFrame:
    """Spans of maximal repeats among the contexts of each gram, all places but the earliest."""

    def group(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        column = whole.column("data")
        doc, tie, low = (whole.column(c).to_numpy() for c in ("doc", "tie", "low"))
        data, offsets = words.utf8(column)
        of = np.repeat(np.arange(len(doc)), np.diff(offsets))
        docs, ties, starts, ends = [], [], [], []
        for size, at in maximal_repeats(data, offsets, length, 2 * length):
            k = of[at]
            place = low[k] + at - offsets[k]
            keep = np.ones(len(at), bool)
            first = _earliest(doc[k], tie[k], place)
            keep[(doc[k] == doc[k[first]]) & (tie[k] == tie[k[first]]) & (place == place[first])] = False
            docs.append(doc[k][keep])
            ties.append(tie[k][keep])
            starts.append(place[keep].astype(np.int64))
            ends.append(starts[-1] + size)
        if docs:
            rows = list(_spans(*(np.concatenate(x) for x in (docs, ties, starts, ends))))
        yield _batch(rows, _SPAN)

    return by_runs(asked.where("many = 0").select("key", "doc", "tie", "low", "data"), ["key"], group, _FOUND, rows=CONTEXT_ROWS)


def _repeats_of_windows(asked: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts: windows whose hash came before."""
    windows = asked.where("many = 1").select("key", "doc", "tie", "low")
    first = windows.groupBy("key").agg(F.min(F.struct("doc", "tie", "low")).alias("first"))
    later = windows.join(first, "key").where(F.struct("doc", "tie", "low") != F.col("first")).select("doc", "tie", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie, low = (np.asarray(batch.column(k)) for k in range(3))
            yield _batch(list(_spans(doc, tie, low.astype(np.int64), low.astype(np.int64) + length)), _SPAN)

    return later.mapInArrow(run, _FOUND)


def earlier_spans(rows: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``found`` rows: for each document, spans that occur earlier."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    found = written(_compare_contexts(_anchor_rows(rows, length, buckets)), "spans")
    asked = written(_requested_bytes(texts, found.where(F.col("kind") > _SPAN), length), "contexts")
    return found.where(F.col("kind") == _SPAN).unionByName(_repeats_of_contexts(asked, length)).unionByName(_repeats_of_windows(asked, length))


def without_repeats(
    docs: DataFrame, *, length: int = 100, id_column: str = "doc_id", text_column: str = "text", with_text: bool = True, seed: int = 9
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept``.

    A byte is removed if it lies in a string of ``length`` bytes of its text that also starts earlier: in a document
    with a smaller id, or further left in the same one. All is judged on the input. ``kept`` are the bytes left, as
    binary, since a cut may part a character; ``n_spans`` counts the removed runs. Ids are whole numbers; a null id
    comes before all others. Rows with equal ids are ordered by a hash of their text; rows equal in both are the same
    document, so they remove nothing from each other and have the same result each. Texts of one id are compared where their
    64-bit hashes agree; should two differ, the job ends with an error, and another ``seed`` parts them. Null texts are empty; texts
    shorter than ``length`` stay whole. Strings are compared by 64-bit hashes where whole contexts agree.
    """
    rows = _keys(docs, id_column, text_column, seed)
    texts = _packed_texts(rows)
    spans = earlier_spans(rows, texts, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        for doc, _, text, times, rest in _documents(batches):
            edge = np.zeros(len(text) + 1, np.int32)
            for _, data in rest:
                n = len(data) // 8
                np.add.at(edge, np.frombuffer(data, "<i4", n), 1)
                np.add.at(edge, np.frombuffer(data, "<i4", n, 4 * n), -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if rest else text
            n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
            row = (None if doc == _NO_ID else doc, len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)
            out += [row] * times
            if len(out) > 500:
                yield batch()
                out = []
        yield batch()

    result = _with_texts(texts, spans).mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return (result if with_text else result.drop("kept")).withColumnRenamed("id", id_column)
