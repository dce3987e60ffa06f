"""Substring dedup (8): FM-index shards, matching statistics, removal of repeated windows.

A window is ``WINDOW`` consecutive words of one document.  A word is removed if it
lies in a window whose words also start earlier: in a document with a smaller id,
or earlier in the same document (windows are judged on the input).

1. Documents are dealt to chunks.  In each window the least hash of its runs of
   ``RUN`` words is its anchor; equal windows have equal anchors.  The anchors are counted over all chunks
   (``counting``): an anchor met once belongs to no repeated window.
2. The windows of the other anchors are counted in the same way.  Windows next to each other that are
   repeated and have the same anchor form a segment, so a passage that many documents share is cut off
   where it ends and is the same segment in all of them.
3. A chunk sends each different segment once, with its first place there, to the shard of the anchor; its other
   occurrences start later and are flagged as a whole.
4. A shard takes its different segments by first place, in parts.  Each part is streamed through
   the compressed FM-indexes (BWT in a wavelet matrix) of the parts before it: backward search gives the matching
   statistics, and where they reach ``WINDOW`` words, the interval's least place is where the window comes first.
   The stretches that are not found there make the part's own index, and are streamed through it.
   All windows after their first place are flagged.
5. Chunks get their flagged intervals back and drop the words they cover.

No step depends on how often an anchor is met.  A shard grows with the different repeated segments of its anchors, and with
one row per chunk for a segment that is met everywhere.

Equal texts are aggregated before: only the first document with a text is
streamed.  Each window of the others starts earlier in that one.

Odd input: a null or empty text has no words; a text shorter than a window stays whole;
a null id comes after all others; rows with the same id and text are one document and get
equal results, rows with the same id and other text follow in the order of the texts' hashes;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import Rolling, Words, chunk_of, chunked, mix, spans_of
from aloft.llm.counting import REQUEST, answered, requests, totals
from aloft.llm.fm_index import FmIndex, matching_statistics

WINDOW, RUN = 20, 6
PART_WORDS = 1 << 18                            # words of a shard that are indexed together
NULL_ID = np.iinfo(np.int64).max
SEGMENT, FLAGGED = range(2)                     # kinds of rows that a chunk sends
ANSWER = "round int, bucket int, answered binary, totals binary"
SEGMENTS = "shard int, chunk int, kind int, ids binary, tids binary, doc binary, start binary, windows binary, words binary"
FLAGS = "chunk int, ids binary, tids binary, doc binary, start binary, length binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class _Chunk:
    """The documents of a chunk to be streamed: first of their texts, each once."""

    def __init__(self, t: pa.Table, firsts: pa.Table):
        self.ids, self.tids = t.column("doc_id").to_pylist(), t.column("tid").to_pylist()
        first = set(zip(firsts.column("doc_id").to_pylist(), firsts.column("tid").to_pylist(), strict=True))
        self.first = [k in first for k in zip(self.ids, self.tids, strict=True)]
        seen: dict = {}
        for i, k in enumerate(zip(self.ids, self.tids, strict=True)):
            if self.first[i]:
                seen.setdefault(k, i)
        self.rows = np.array(list(seen.values()), dtype=np.int64)
        self.of = seen

    def segments(self, t: pa.Table):
        texts = t.column("text").combine_chunks().take(pa.array(self.rows))
        return _Segments(Words(texts))


class _Segments:
    """The segments of some texts: doc, start (word in the text), windows, anchor; ``words``: all words' hashes."""

    def __init__(self, words: Words):
        self.words = words.hashes()
        self.starts = words.starts
        n = np.maximum(words.counts - WINDOW + 1, 0)
        doc, place = spans_of(n)
        if not len(doc):
            self.doc = self.start = self.windows = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        runs = len(self.words) - RUN + 1
        h = Rolling(self.words).run(np.arange(runs), RUN)
        best, width, need = np.arange(runs), 1, WINDOW - RUN + 1

        def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.where(h[b] < h[a], b, a)                      # the first of equals

        while width * 2 <= need:
            best = np.append(better(best[:-width], best[width:]), best[-width:])
            width *= 2
        at = words.starts[doc] + place
        anchor = better(best[at], best[at + need - width])
        new = np.ones(len(at), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        self.doc, self.start, self.anchor = doc[head], place[head], h[anchor[head]]
        self.windows = np.diff(np.append(head, len(at)))


def _anchors(buckets: int):
    def run(key, t: pa.Table, side: pa.Table) -> pa.Table:
        s = _Chunk(t, side).segments(t)
        anchors, counts = np.unique(s.anchor, return_counts=True)
        return pa.Table.from_batches([requests(key[0].as_py(), anchors, counts, buckets)])
    return run


def _repeated(own: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return whole[:, 0] > 1


def _ranks(ids: np.ndarray, tids: np.ndarray) -> np.ndarray:
    """The documents' order by id, then text (equal ones have one rank)."""
    every = np.column_stack([ids.astype(np.uint64) ^ np.uint64(1 << 63), tids.reshape(-1, 2)])
    return np.unique(every, axis=0, return_inverse=True)[1].ravel()


def _again(s: _Segments, side: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows whose anchors are repeated: segment, place in the text, begin among all words, hash."""
    anchors, which = np.unique(s.anchor, return_inverse=True)
    again, _ = answered(_round(side, 0), anchors, buckets, 1)
    use = np.flatnonzero(np.isin(which, again))
    of, place = spans_of(s.windows[use])
    segment = use[of]
    at = s.start[segment] + place
    begin = s.starts[s.doc[segment]] + at
    return segment, at, begin, Rolling(s.words).run(begin, WINDOW) if len(begin) else np.zeros(0, np.uint64)


def _round(side: pa.Table, k: int) -> pa.Table:
    return side.filter(pc.fill_null(pc.equal(side.column("round"), k), False))


def _windows(buckets: int):
    def run(key, t: pa.Table, side: pa.Table) -> pa.Table:
        s = _Chunk(t, side.filter(side.column("round").is_null())).segments(t)
        keys, counts = np.unique(_again(s, side, buckets)[3], return_counts=True)
        return pa.Table.from_batches([requests(key[0].as_py(), keys, counts, buckets)])
    return run


def _route(shards: int, buckets: int):
    names = [f.split()[0] for f in SEGMENTS.split(", ")]
    schema = pa.schema([(n, pa.int32() if n in ("shard", "chunk", "kind") else pa.binary()) for n in names])

    def run(key, t: pa.Table, side: pa.Table) -> pa.Table:
        chunk = _Chunk(t, side.filter(side.column("round").is_null()))
        s = chunk.segments(t)
        segment, at, begin, h = _again(s, side, buckets)
        keys, which = np.unique(h, return_inverse=True)
        use = np.flatnonzero(np.isin(which, answered(_round(side, 1), keys, buckets, 1)[0]))
        if not len(use):
            return schema.empty_table()
        segment, at, begin = segment[use], at[use], begin[use]
        new = np.ones(len(use), dtype=bool)
        new[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        windows = np.diff(np.append(head, len(use)))
        doc, start, begin, anchor = s.doc[segment[head]], at[head], begin[head], s.anchor[segment[head]]
        ids = np.array([NULL_ID if i is None else i for i in chunk.ids], dtype="<i8")[chunk.rows]
        tids = np.array([np.frombuffer(x, dtype="<u8") for x in chunk.tids]).reshape(-1, 2)[chunk.rows]
        # the first occurrence of each different segment; the others are repeated as a whole
        length = windows + WINDOW - 1
        content = np.column_stack([Rolling(s.words).run(begin, length), Rolling(mix(s.words)).run(begin, length)])
        order = np.lexsort((start, _ranks(ids, tids)[doc], content[:, 1], content[:, 0]))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (content[order[1:]] != content[order[:-1]]).any(axis=1)
        rows = []

        def send(shard: np.ndarray, kind: int, of: np.ndarray, words) -> None:
            of = of[np.argsort(shard[of], kind="stable")]
            used, head = np.unique(shard[of], return_index=True)
            for k, lo, hi in zip(used.tolist(), head.tolist(), [*head[1:].tolist(), len(of)], strict=False):
                u = of[lo:hi]
                docs, local = np.unique(doc[u], return_inverse=True)
                rows.append((k, key[0].as_py(), kind, ids[docs].tobytes(), tids[docs].tobytes(), local.astype("<i4").tobytes(),
                             start[u].astype("<i4").tobytes(), windows[u].astype("<i4").tobytes(), words(u).astype("<u8").tobytes()))

        def words(u: np.ndarray) -> np.ndarray:
            of, place = spans_of(length[u])
            return s.words[begin[u][of] + place]

        send((anchor % np.uint64(shards)).astype(np.int32), SEGMENT, order[first], words)
        send(np.full(len(head), key[0].as_py() % shards), FLAGGED, order[~first], lambda u: np.zeros(0))
        return pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)
    return run


def _search(part_words: int):
    def run(t: pa.Table) -> pa.Table:
        """One shard: flagged windows as intervals, of both kinds of rows."""
        kind = t.column("kind").to_numpy()
        own = {k: t.filter(pa.array(kind == k)) for k in (SEGMENT, FLAGGED)}
        out = [_told(own[FLAGGED])] if own[FLAGGED].num_rows else []
        return pa.concat_tables([*out, _indexed(own[SEGMENT], part_words)] if own[SEGMENT].num_rows else out)
    return run


def _told(t: pa.Table) -> pa.Table:
    """What chunks have flagged themselves."""
    length = [(np.frombuffer(x, "<i4") + WINDOW - 1).astype("<i4").tobytes() for x in t.column("windows").to_pylist()]
    return t.select(["chunk", "ids", "tids", "doc", "start"]).append_column("length", pa.array(length, pa.binary()))


def first_places(symbols: np.ndarray, size: np.ndarray, first: np.ndarray, part_words: int) -> np.ndarray:
    """For each window of different segments (runs of ``symbols`` of the given sizes, each at a place of its own): the least place
    at which it starts.  Segments are taken by place in parts (two at least); see the module's step 4."""
    begin, n_windows = np.cumsum(size) - size, size - WINDOW + 1
    base = np.cumsum(n_windows) - n_windows
    found = np.full(int(n_windows.sum()), -1, dtype=np.int64)
    order = np.argsort(first, kind="stable")
    before = np.cumsum(size[order]) - size[order]
    parts = max(2, -(-int(size.sum()) // part_words))
    part = before * parts // int(size.sum())
    indexes: list[FmIndex] = []

    def stream(index: FmIndex, at: np.ndarray, length: np.ndarray, window: np.ndarray) -> None:
        of, place = spans_of(length)
        for run, position, _, low, _ in matching_statistics(index, symbols[at[of] + place], length, WINDOW):
            found[window[run] + position] = index.first_place(low)

    def missing(seg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stretches of windows not found yet: begin among the symbols, length, first window, place."""
        of, j = spans_of(n_windows[seg])
        open_ = found[base[seg][of] + j] < 0
        of, j = of[open_], j[open_]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (j[1:] != j[:-1] + 1)
        head = np.flatnonzero(new)
        s, j = seg[of[head]], j[head]
        return begin[s] + j, np.diff(np.append(head, len(of))) + WINDOW - 1, base[s] + j, first[s] + j

    for p in range(parts):
        seg = order[part == p]
        for index in indexes:
            at, length, window, _ = missing(seg)
            if len(at):
                stream(index, at, length, window)
        at, length, window, place = missing(seg)
        if len(at):
            of, j = spans_of(length)
            indexes.append(FmIndex(symbols[at[of] + j], length, WINDOW, place[of] + j))
            stream(indexes[-1], at, length, window)
    return found


def _indexed(t: pa.Table, part_words: int) -> pa.Table:
    """First places of the windows of its different segments, flagged windows as intervals."""
    def numbers(name: str, kind: str) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype=kind) for x in t.column(name).to_pylist()]

    ids, tids, doc = numbers("ids", "<i8"), numbers("tids", "<u8"), numbers("doc", "<i4")
    start, windows = np.concatenate(numbers("start", "<i4")).astype(np.int64), np.concatenate(numbers("windows", "<i4")).astype(np.int64)
    row = np.repeat(np.arange(t.num_rows), [len(d) for d in doc])
    offset = np.cumsum([0, *(len(i) for i in ids)])[:-1]
    own = (_ranks(np.concatenate(ids), np.concatenate(tids))[offset[row] + np.concatenate(doc)] << 32) | start
    _, words = np.unique(np.concatenate(numbers("words", "<u8")), return_inverse=True)
    words = words + 1
    length = windows + WINDOW - 1
    begin = np.cumsum(length) - length
    content = Rolling(words.astype(np.uint64)).run(begin, length)
    _, sample, kind = np.unique(content, return_index=True, return_inverse=True)
    first = np.full(len(sample), np.iinfo(np.int64).max)
    np.minimum.at(first, kind, own)                                   # where each different segment comes first
    size = length[sample]
    of, place = spans_of(size)
    symbols = words[begin[sample][of] + place]
    place_of = first_places(symbols, size, first, part_words)
    n_windows = size - WINDOW + 1
    base = np.cumsum(n_windows) - n_windows
    # every occurrence of every segment against the first places
    occ, j = spans_of(windows)
    late = own[occ] + j > place_of[base[kind][occ] + j]
    new = late.copy()
    new[1:] &= ~late[:-1] | (occ[1:] != occ[:-1])
    head = np.flatnonzero(new)
    stop = late.copy()
    stop[:-1] &= ~late[1:] | (occ[1:] != occ[:-1])
    tail = np.flatnonzero(stop)
    out = []
    source = row[occ[head]]
    local = np.concatenate(doc)[occ[head]]
    chunks = t.column("chunk").to_pylist()
    for r in np.unique(source).tolist():
        u = np.flatnonzero(source == r) if t.num_rows < 4 else slice(*np.searchsorted(source, [r, r + 1]))
        h, e = head[u], tail[u]
        out.append({"chunk": chunks[r], "ids": ids[r].tobytes(), "tids": tids[r].tobytes(), "doc": local[u].astype("<i4").tobytes(),
                    "start": (start[occ[h]] + j[h]).astype("<i4").tobytes(), "length": (e - h + WINDOW).astype("<i4").tobytes()})
    return pa.Table.from_pylist(out, schema=pa.schema([("chunk", pa.int32()), *((n, pa.binary()) for n in ("ids", "tids", "doc", "start", "length"))]))


def _remove(key, t: pa.Table, side: pa.Table) -> pa.Table:
    flags = side.filter(side.column("ids").is_valid())
    chunk = _Chunk(t, side.filter(side.column("ids").is_null()))
    gone: dict[int, list[tuple[int, int]]] = {}
    for f in flags.to_pylist():
        ids, tids = np.frombuffer(f["ids"], "<i8").tolist(), np.frombuffer(f["tids"], "<u8").reshape(-1, 2)
        rows = [chunk.of[None if i == NULL_ID else i, x.tobytes()] for i, x in zip(ids, tids, strict=True)]
        for d, a, n in zip(*(np.frombuffer(f[c], "<i4").tolist() for c in ("doc", "start", "length")), strict=True):
            gone.setdefault(rows[d], []).append((a, a + n))
    out = []
    for i, text in enumerate(t.column("text").to_pylist()):
        words = text.encode().split()
        kept = words
        if not chunk.first[i]:
            kept = words if len(words) < WINDOW else []
        else:
            spans = gone.get(chunk.of[chunk.ids[i], chunk.tids[i]])
            if spans:
                mask = np.ones(len(words) + 1, dtype=np.int64)
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                a, b = np.array(spans).T
                np.add.at(edges, a, 1)
                np.add.at(edges, b, -1)
                mask = np.cumsum(edges) == 0
                kept = [w for w, k in zip(words, mask.tolist(), strict=False) if k]
        out.append((chunk.ids[i], len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(
        zip(*out, strict=True) if out else [[]] * 4, [pa.int64()] * 3 + [pa.string()], strict=True)],
        names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _routed(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int):
    """What the chunks send to the shards (see SEGMENTS), the texts by chunk, and what makes the other side of a cogroup with them."""
    texts, n = chunked(docs, id_col, text_col, chunk_bytes)
    # the first document of each text: the others are wholly repeated
    firsts = (texts.groupBy("tid").agg(F.min("doc_id").alias("doc_id"))
              .select(chunk_of(n, "doc_id", F.col("tid")).alias("chunk"), "doc_id", F.substring("tid", 1, 16).alias("tid")))

    def side(more: str, rows: DataFrame | None = None) -> DataFrame:
        columns = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in more.split(", ")]
        out = firsts.select("chunk", "doc_id", "tid", *columns)
        if rows is not None:
            out = out.unionByName(rows.select("chunk", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tid"),
                                              *[f.split()[0] for f in more.split(", ")]))
        return out.groupBy("chunk")

    by_chunk = texts.groupBy("chunk")
    buckets = max(1, n // 4)
    sent = by_chunk.cogroup(side("bucket int")).applyInArrow(_anchors(buckets), REQUEST)
    anchors = totals(sent, _repeated).where("chunk >= 0").withColumn("round", F.lit(0))
    sent = by_chunk.cogroup(side(ANSWER, anchors)).applyInArrow(_windows(buckets), REQUEST)
    windows = totals(sent, _repeated).where("chunk >= 0").withColumn("round", F.lit(1))
    segments = by_chunk.cogroup(side(ANSWER, anchors.unionByName(windows))).applyInArrow(_route(n, buckets), SEGMENTS)
    return segments, by_chunk, side


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20,
                   part_words: int = PART_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    segments, by_chunk, side = _routed(docs, id_col, text_col, chunk_bytes)
    flags = segments.groupBy("shard").applyInArrow(_search(part_words), FLAGS)
    return by_chunk.cogroup(side("ids binary, tids binary, doc binary, start binary, length binary", flags)).applyInArrow(_remove, RESULT)
