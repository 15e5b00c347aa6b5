"""Suffix-array dedup: bytes of repeated substrings go, by blockwise sorting of suffixes over a cover sample.

A byte goes if a substring of ``length`` bytes that covers it also starts in a document with a smaller id.
Only the first ``length`` bytes of a suffix matter, so a suffix is a window of that many bytes.

Cover sample. Every window is represented by one sampled position inside it, its minimiser: the smallest
hash among its ``gram``-byte substrings, leftmost of equals. Equal windows have it at the same offset, which
is what a difference cover gives, at a density of 2 / (length - gram + 2) instead of the three to four times
denser modular covers. Windows with one minimiser are consecutive and travel as one context.

Steps. (1) The sample's grams are aggregated to their smallest and largest document; those in one document
only can't be repeated. The rest go into a bit map of fixed size. (2) Contexts whose gram is in the bit map
are dealt to buckets by content of the gram; equal contexts are met within a batch first, so a large group of
copies sends one each. (3) One bucket at a time, its suffixes are sorted by hash of their window, runs of equal
windows are compared byte by byte, and those of larger documents are marked. (4) Marks join their documents.
A bucket holds ``bucket_bytes`` of text on average, whatever the size of the table.

Hot grams. A gram whose contexts alone would fill a bucket (a phrase or a rule of dashes that many documents
surround differently) sends windows instead, dealt by the hash of all their bytes. Equal windows hold the same
gram and share that hash, so they still meet. Each batch marks all but the smallest document of a window at once
and sends only that one, with one of its places: a mark of such a place stands for ``every`` equal window of its
text, and the last step finds the others there. So a window costs a bucket a row or so per batch of text, however
often it occurs, also within one document (runs of blanks, rules, padding).

Defined results: a null text is empty; null ids come after all others; rows that repeat an id never mark each
other; rows that repeat id and text get the same result; texts shorter than ``length`` keep every byte; other
columns are ignored. The bit maps let more contexts through, or send more of them as windows, as grams fill
them; results don't depend on it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sensorqc.llm.base import arrow_map, id_filter, materialise, texts_of


@dataclass(frozen=True)
class SuffixSettings:
    length: int = 50
    gram: int = 18
    bucket_bytes: int = 3 << 20
    group_bytes: int = 4 << 20
    filter_bits: int = 26
    hot_bits: int = 22

    @property
    def hot_contexts(self) -> int:
        """So many contexts of one gram would fill a bucket."""
        return max(1, self.bucket_bytes // (2 * self.length))


_LAST = np.iinfo(np.int64).max
_MULT = np.uint64(0x9E3779B97F4A7C15)
_HEAD = np.dtype([("order", "<i8"), ("text", "<i8"), ("at", "<i8"), ("size", "<i4"), ("every", "<i4")])

#: Marks: the document, the hash of its text, first and last window, and whether windows elsewhere in it that equal one of these count too.
MARK = ["order", "hash", "first", "last", "every"]


def _mix(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(32)
    y ^= x
    y *= _MULT
    y ^= y >> np.uint64(29)
    return y


def words8(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one number; zeros follow the end."""
    x = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x[: len(buf)]


def _offsets(size: int) -> list[int]:
    """Where the 8-byte words after the first lie that cover ``size`` (8 at least) bytes."""
    return [*range(8, size - 7, 8), *([size - 8] if size % 8 else [])]


def block_hash(w8: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position."""
    h = _mix(w8[at])
    for off in _offsets(size):
        h = _mix(h ^ w8[at + off])
    return h


def all_hashes(w8: np.ndarray, size: int) -> np.ndarray:
    """``block_hash`` of every position with so many bytes behind it."""
    n = len(w8) - size + 1
    h = _mix(w8[:n])
    for off in _offsets(size):
        h = _mix(h ^ w8[off : off + n])
    return h


def runs(buf: np.ndarray, ends: np.ndarray, cfg: SuffixSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, gram hash) of each run of windows with one minimiser; texts end at ``ends``."""
    n, span = len(buf), cfg.length - cfg.gram + 1
    if n < cfg.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        grams = all_hashes(words8(buf), cfg.gram)
    low = np.uint64((1 << 24) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[: len(key) - (span - width)], key[span - width :]) if span > width else key
    chosen = (key & low).astype(np.int64)  # the minimiser of the window at each position
    start = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(len(chosen) + 1, np.int64)
    whole = ends - start >= cfg.length
    np.add.at(valid, start[whole], 1)
    np.add.at(valid, ends[whole] - cfg.length + 1, -1)
    inside = np.cumsum(valid)[:-1] > 0
    fresh = np.ones(len(chosen), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    fresh[start[whole]] = True
    first = np.flatnonzero(fresh & inside)
    stop = np.flatnonzero(np.concatenate([fresh[1:] | ~inside[1:], [True]]) & inside) + 1
    return first, stop - first, grams[chosen[first]].view(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], cfg: SuffixSettings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, order, text hash, offset) of groups of texts; long texts come in overlapping parts."""
    parts: list[tuple[bytes, int, int, int]] = []
    size = 0

    def flush():
        buf = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
        return buf, np.cumsum([len(p[0]) for p in parts]), *(np.array([p[i] for p in parts], np.int64) for i in (1, 2, 3))

    for b in batches:
        orders, hashes = (b.column(c).to_pylist() for c in ("order", "hash"))
        for text, order, h in zip(texts_of(b.column("_sd_text")), orders, hashes, strict=True):
            for off in range(0, max(len(text) - cfg.length + 1, 0), cfg.group_bytes):
                part = text[off : off + cfg.group_bytes + cfg.length - 1]
                parts.append((part, order, h, off))
                size += len(part)
                if size >= cfg.group_bytes:
                    yield flush()
                    parts, size = [], 0
    if parts:
        yield flush()


def shared_grams(rows: DataFrame, cfg: SuffixSettings) -> DataFrame:
    """gram of every sampled gram that lies in two documents, and n, about the contexts that batches would send for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buf, ends, order, _, _ in _groups(batches, cfg):
            first, count, gram = runs(buf, ends, cfg)
            doc = order[np.searchsorted(ends, first, "right")]
            by = np.lexsort((doc, gram))
            gram, doc, first, count = gram[by], doc[by], first[by], count[by]
            head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
            tail = np.concatenate([head[1:], [len(gram)]]) - 1 if len(gram) else head
            n = tail - head + 1
            often = np.flatnonzero(n > 8)
            if len(often):  # equal contexts are sent once
                raw, tail_bytes = buf.tobytes(), cfg.length - 1
                for i in often.tolist():
                    at = range(head[i], tail[i] + 1)
                    n[i] = len({raw[first[j] : first[j] + count[j] + tail_bytes] for j in at})
            yield pa.RecordBatch.from_arrays([pa.array(gram[head]), pa.array(doc[head]), pa.array(doc[tail]), pa.array(n)], ["gram", "lo", "hi", "n"])

    found = arrow_map(rows, run, "gram long, lo long, hi long, n long").groupBy("gram").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    return materialise(found.filter("lo < hi").select("gram", "n"), "shared-grams")


def merged(marks: list[tuple[int, ...]]) -> np.ndarray:
    """Marks as rows, those of one text that touch or overlap as one."""
    m = np.array(marks, np.int64).reshape(-1, 5)
    m = m[np.lexsort((m[:, 2], m[:, 4], m[:, 1], m[:, 0]))]
    if len(m) < 2:
        return m
    fresh = np.ones(len(m), bool)
    fresh[1:] = (m[1:, [0, 1, 4]] != m[:-1, [0, 1, 4]]).any(1)
    group = np.cumsum(fresh) << 40  # beyond any position
    reach = np.maximum.accumulate(group + m[:, 3])
    fresh[1:] |= m[1:, 2] + group[1:] > reach[:-1] + 1
    head = np.flatnonzero(fresh)
    out = m[head]
    out[:, 3] = (reach - group)[np.concatenate([head[1:] - 1, [len(m) - 1]])]
    return out


def _pack(entries: list[tuple[int, int, int, int, bytes]]) -> bytes:
    head = np.array([(o, h, a, len(c), x) for o, h, a, x, c in entries], _HEAD)
    return zlib.compress(len(entries).to_bytes(4, "little") + head.tobytes() + b"".join(e[4] for e in entries), 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zlib.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, _HEAD, n, 4), raw[4 + n * _HEAD.itemsize :]


def _split(buf: np.ndarray, first: np.ndarray, count: np.ndarray, order: np.ndarray, text: np.ndarray, cfg: SuffixSettings) -> tuple[np.ndarray, ...]:
    """Windows of contexts: (context, first step, last step) of runs that a smaller document here holds too; of the
    others, one for each window and text, (context, step, hash, whether it is there more than once)."""
    entry = np.repeat(np.arange(len(first)), count)
    step = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    w8, at = words8(buf), first[entry] + step
    names, mine = equal_windows(w8, at, cfg.length), order[entry]
    least = np.full(names.max(initial=-1) + 1, _LAST)
    np.minimum.at(least, names, mine)
    hit = mine > least[names]
    opens, closes = _run_ends(hit, step)
    rest = np.flatnonzero(~hit)
    by = rest[np.lexsort((text[entry[rest]], mine[rest], names[rest]))]
    fresh = np.ones(len(by), bool)
    fresh[1:] = (names[by[1:]] != names[by[:-1]]) | (mine[by[1:]] != mine[by[:-1]]) | (text[entry[by[1:]]] != text[entry[by[:-1]]])
    head = np.flatnonzero(fresh)
    one = by[head]
    with np.errstate(over="ignore"):
        h = block_hash(w8, at[one], cfg.length).view(np.int64)
    return entry[opens], step[opens], step[closes], entry[one], step[one], h, np.diff(head, append=len(by)) > 1


def _run_ends(hit: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of hits begin and end; a run stays within its context, whose steps count from 0."""
    opens = hit & ~(np.concatenate([[False], hit[:-1]]) & (step > 0))
    closes = hit & ~(np.concatenate([hit[1:], [False]]) & np.concatenate([step[1:] > 0, [False]]))
    return np.flatnonzero(opens), np.flatnonzero(closes)


def contexts(rows: DataFrame, grams: DataFrame, buckets: int, cfg: SuffixSettings) -> DataFrame:
    """bucket, known, blob: contexts to compare or, where ``known``, marks that need no more comparing."""
    maybe = id_filter(grams.select("gram"), cfg.filter_bits)
    # a bit map again: what it takes for hot besides is sent as windows too, which is as exact
    hot = id_filter(grams.filter(F.col("n") > cfg.hot_contexts).select("gram"), cfg.hot_bits)
    tail = cfg.length - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buf, ends, order, text, offset in _groups(batches, cfg):
            first, count, gram = runs(buf, ends, cfg)
            keep = maybe(pa.array(gram)) if len(gram) else np.zeros(0, bool)
            first, count, gram = first[keep], count[keep], gram[keep]
            part = np.searchsorted(ends, first, "right")
            at = first - np.concatenate([[0], ends[:-1]])[part] + offset[part]
            raw, seen = buf.tobytes(), {}
            out: dict[int, list] = {}
            marks = []
            split = hot(pa.array(gram)) if len(gram) else keep[:0]
            if split.any():
                orders, texts, ats, starts = order[part][split], text[part][split], at[split], first[split]
                e, a, b, other, step, h, more = _split(buf, starts, count[split], orders, texts, cfg)
                marks += zip(orders[e].tolist(), texts[e].tolist(), (ats[e] + a).tolist(), (ats[e] + b).tolist(), [0] * len(e), strict=True)
                begin = starts[other] + step
                for to, o, t, i, x, s in zip((h % buckets).tolist(), orders[other].tolist(), texts[other].tolist(), (ats[other] + step).tolist(), more.tolist(), begin.tolist(), strict=True):
                    out.setdefault(to, []).append((o, t, i, x, raw[s : s + cfg.length]))
                first, count, gram, part, at = first[~split], count[~split], gram[~split], part[~split], at[~split]
            for s, c, g, o, h, a in zip(first.tolist(), count.tolist(), gram.tolist(), order[part].tolist(), text[part].tolist(), at.tolist(), strict=True):
                seen.setdefault(raw[s : s + c + tail], (g, []))[1].append((o, h, a))
            for context, (g, places) in seen.items():
                if len(places) == 1:
                    o, h, a = places[0]
                    out.setdefault(g % buckets, []).append((o, h, a, 0, context))
                    continue
                least, sent = min(places)[0], {}
                for o, h, a in places:
                    if o == least:
                        sent.setdefault((o, h), []).append(a)
                    else:
                        marks.append((o, h, a, a + len(context) - cfg.length, 0))
                for (o, h), ats in sent.items():
                    out.setdefault(g % buckets, []).append((o, h, ats[0], len(ats) > 1, context))
            blobs = [_pack(x) for x in out.values()]
            known = [zlib.compress(merged(marks).astype("<i8").tobytes(), 1)] if marks else []
            ids = [*out, *(m[0] % buckets for m in marks[: len(known)])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([False] * len(blobs) + [True] * len(known), pa.bool_()), pa.array(blobs + known, pa.binary())], ["bucket", "known", "blob"])

    return arrow_map(rows, run, "bucket long, known boolean, blob binary")


def equal_windows(w8: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A number for each window such that equal windows, and only they, share it."""
    with np.errstate(over="ignore"):
        h = block_hash(w8, at, length)
    offs = [0, *_offsets(length)]
    by = np.argsort(h, kind="stable")

    def equal(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([w8[at[i] + o] == w8[at[j] + o] for o in offs])

    new = h[by[1:]] != h[by[:-1]]
    alike = np.flatnonzero(~new)
    if not equal(by[alike + 1], by[alike]).all():  # two windows of one hash: sort by all bytes
        by = np.lexsort([w8[at + o] for o in offs])
        new = ~equal(by[1:], by[:-1])
    names = np.empty(len(at), np.int64)
    names[by] = np.concatenate([[0], np.cumsum(new)])
    return names


def mark_bucket(heads: np.ndarray, raw: bytes, cfg: SuffixSettings) -> np.ndarray:
    """Marks of runs of windows that also start in a smaller document."""
    order, text, at, every = (heads[c].tolist() for c in ("order", "text", "at", "every"))
    ends = np.cumsum(heads["size"].astype(np.int64)).tolist()
    same: dict[bytes, list[int]] = {}
    begin = 0
    for e, end in enumerate(ends):
        same.setdefault(raw[begin:end], []).append(e)
        begin = end
    # whole contexts first: all but those of the smallest document are marked, and one is compared on
    out, least, owners = [], [], []
    for context, entries in same.items():
        low = min(order[e] for e in entries)
        out += [(order[e], text[e], at[e], at[e] + len(context) - cfg.length, every[e]) for e in entries if order[e] != low]
        least.append(low)
        owners.append([e for e in entries if order[e] == low])
    size = np.array([len(c) for c in same], np.int64)
    count = size - cfg.length + 1
    entry = np.repeat(np.arange(len(size)), count)
    step = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    names = equal_windows(words8(np.frombuffer(b"".join(same), np.uint8)), (np.cumsum(size) - size)[entry] + step, cfg.length)
    mine = np.array(least, np.int64)[entry]
    first = np.full(names.max(initial=-1) + 1, _LAST)
    np.minimum.at(first, names, mine)
    hit = mine > first[names]
    for a, b in zip(*(x.tolist() for x in _run_ends(hit, step)), strict=True):
        out += [(order[e], text[e], at[e] + int(step[a]), at[e] + int(step[b]), every[e]) for e in owners[entry[a]]]
    return merged(out)


def marks(docs: DataFrame, cfg: SuffixSettings = SuffixSettings()) -> DataFrame:
    """order, hash, first, last, every: starts of repeated windows, as ranges."""
    rows = _rows(docs)
    total = rows.agg(F.sum(F.octet_length("_sd_text"))).first()[0] or 0
    buckets = max(16, -(-total // cfg.bucket_bytes))
    found = contexts(rows, shared_grams(rows, cfg), buckets, cfg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None

        def batch(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(rows[:, i].astype(np.int64)) for i in range(4)), pa.array(rows[:, 4] != 0)], MARK)

        def finish() -> pa.RecordBatch:
            heads, raws = zip(*held, strict=True)
            return batch(mark_bucket(np.concatenate(heads), b"".join(raws), cfg))

        for b in batches:
            for i, known, blob in zip(*(b.column(c).to_pylist() for c in ("bucket", "known", "blob")), strict=True):
                if known:
                    yield batch(np.frombuffer(zlib.decompress(blob), "<i8").reshape(-1, 5))
                    continue
                if bucket is not None and i != bucket:
                    yield finish()
                    held = []
                bucket = i
                held.append(_unpack(blob))
        if held:
            yield finish()

    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(dealt, run, "order long, hash long, first long, last long, every boolean")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("order"), F.xxhash64(text, F.col("doc_id").isNull()).alias("hash"), text.alias("_sd_text"))


def _elsewhere(text: bytes, spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Ranges of the windows that equal one of the given ranges' windows, wherever they start in the text."""
    every = [s for s in spans if s["every"]]
    if not every:
        return []
    w8 = words8(np.frombuffer(text, np.uint8))
    with np.errstate(over="ignore"):
        h = all_hashes(w8, length)
    known = np.unique(np.concatenate([np.arange(s["first"], s["last"] + 1) for s in every]))
    # windows of one hash are equal unless another window shares it: compare with the first of that hash
    names, first = np.unique(h[known], return_index=True)
    like = np.flatnonzero(np.isin(h, names))
    model = known[first[np.searchsorted(names, h[like])]]
    same = np.logical_and.reduce([w8[like + o] == w8[model + o] for o in [0, *_offsets(length)]])
    rest = like[~same]  # other windows of a shared hash, one by one
    texts = {text[i : i + length] for i in known.tolist()} if len(rest) else set()
    also = [i for i in rest.tolist() if text[i : i + length] in texts]
    at = np.sort(np.concatenate([like[same], np.array(also, np.int64)]))
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), at[np.concatenate([cut, [len(at) - 1]])].tolist(), strict=True))


def _cover(text: bytes, spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges [from, to) covered by windows that start in the given ranges."""
    out: list[list[int]] = []
    ranges = [(s["first"], s["last"]) for s in spans] + _elsewhere(text, spans, length)
    for a, b in sorted((a, b + length) for a, b in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup_substrings(docs: DataFrame, cfg: SuffixSettings = SuffixSettings()) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    spans = marks(docs, cfg).groupBy("order", "hash").agg(F.collect_set(F.struct("first", "last", "every")).alias("_sd_spans"))
    rows = _rows(docs).withColumn("doc_id", F.when(F.col("order") != _LAST, F.col("order")).cast(docs.schema["doc_id"].dataType))
    joined = rows.join(spans, ["order", "hash"], "left").select("doc_id", "_sd_text", "_sd_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, sizes, removed, counts = [], [], [], []
            for text, spans in zip(texts_of(b.column("_sd_text")), b.column("_sd_spans").to_pylist(), strict=True):
                cover, parts, at = _cover(text, spans or [], cfg.length), [], 0
                for a, e in cover:
                    parts.append(text[at:a])
                    at = e
                kept.append(b"".join([*parts, text[at:]]))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                counts.append(len(cover))
            sums = pa.array([sha256(k).hexdigest() for k in kept], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)), sums], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("kept", T.BinaryType())]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    return arrow_map(joined, run, T.StructType(fields))
