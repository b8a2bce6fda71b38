"""Exact removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a `length`-byte string (50) that covers it also starts in a document with a smaller
doc_id. Documents are dealt to blocks by doc_id; nothing is collected, and no task holds more than
a block, or the entries of one bucket or group.

1. Anchors. In every window of `length` bytes the K-gram of least hash is an anchor. The choice
   depends on the window's bytes alone, so equal windows have anchors at the same place, and the suffixes
   at anchors (about 7 % of all) stand for all suffixes.
2. Each block sends the hashes of its anchors' K-grams, sorted and delta-coded; a bucket answers which
   occur in two documents or more. Only those anchors can be part of a repeat (a hash collision
   merely keeps one more).
3. Each block sorts the suffixes at the anchors that are left, folds equal ones (with equal bytes
   before the anchor) to the smallest doc_id, and sends them as front-coded runs. A group of copies
   is therefore one entry per block, however large it is.
4. A bucket merges its runs by a loser tree that never compares a known prefix again. Suffixes that
   share the K-gram come out side by side; for each the furthest matching bytes to the left and right
   with a smaller doc_id follow. The answers go back to the blocks, which cut the texts.
5. A K-gram with more than `most` entries in all (documents that share a passage have different bytes
   before or after it, so near its ends each has an entry of its own) is resolved apart, window by
   window: each block sends the distinct `length`-byte windows around its anchors with their smallest
   doc_id, dealt to groups by K-gram, place and bytes, and a group answers which windows a smaller doc_id has.

Bytes are compared, not hashes, so matches are exact and never cross documents.

Defined results: null text is empty; texts under `length` bytes lose nothing; rows with equal doc_id
are one document for this purpose (they do not cut each other) but keep a row each; a null doc_id
neither cuts nor is cut; other columns are ignored; an empty table gives an empty result.

Scale: blocks and buckets grow with the input (`block_bytes`, 4 MB by default; a bucket answers
for three blocks' worth, as it reads its runs as a stream); a row of the
exchanges is a whole packed run, so there are blocks x buckets of them. For tables of many TB raise
block_bytes with the executors' memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import release as _release
from registrum.llm.common import text_column
from registrum.llm.loser_tree import merge_front_coded, shared

K = 24  # bytes of an anchor's K-gram
HASH_BITS = 40
FEW = 4  # anchors of a K-gram in a block whose surroundings are not compared to count its entries
SALT_BITS = 14
WINDOWS = 1 << 18  # of one K-gram and place that go to one group, about
CHUNK = 1 << 20  # bytes whose K-grams are hashed at a time
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _slide(a: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over every `width` neighbours, by doubling."""
    done, size = a, 1
    while size * 2 <= width:
        done = best(done[:-size], done[size:])
        size *= 2
    return best(done[: len(a) - width + 1], done[width - size :])


def _pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes (high bytes are mostly zero)."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if len(values) else b""


def _unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").ravel()


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


class _Block:
    """The texts of a block behind one another, and their anchors."""

    def __init__(self, rows: pa.Table, length: int) -> None:
        ids = rows.column("doc_id").to_pylist()
        texts = [x or b"" for x in rows.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))  # the same at every reading
        self.ids, self.texts, self.length = [ids[i] for i in order], [texts[i] for i in order], length
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.data = np.frombuffer(b"".join([*self.texts, bytes(256)]), np.uint8)
        self.n = len(self.data) - 256
        self.padded = np.concatenate([np.zeros(length - K, np.uint8), self.data])
        self.numbers = np.array([i if i is not None else 0 for i in self.ids], np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of anchors in documents that take part, their rows, and the hashes of their K-grams."""
        width, margin = self.length - K + 1, self.length
        usable = np.zeros(self.n + 1, np.int8)  # places where a K-gram of a participating document starts
        on = np.array([i is not None for i in self.ids], bool) & (self.sizes >= self.length)
        np.add.at(usable, self.begins[on], 1)
        np.add.at(usable, self.ends[on] - K + 1, -1)
        usable = np.cumsum(usable[:-1], dtype=np.int8).astype(bool)
        places, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for start in range(0, self.n, CHUNK):  # a place depends on the bytes within `margin` of it only
            lo, hi = max(0, start - margin), min(self.n, start + CHUNK + margin)
            if hi - lo < width:
                continue
            words = np.ndarray((hi - lo + 16,), "<u8", buffer=self.data[lo:], strides=(1,))
            n = hi - lo
            hashes = _mix(words[:n] * _A + _mix(words[8 : n + 8] * _B + _mix(words[16 : n + 16] * _A)))
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            short[~usable[lo:hi]] = 0xFFFFFFFF
            least = _slide(short, width, np.minimum)
            pad = np.zeros(width - 1, np.uint32)
            reach = _slide(np.concatenate([pad, least, pad]), width, np.maximum)
            at = np.flatnonzero((reach == short) & usable[lo:hi]) + lo
            own = (at >= start) & (at < start + CHUNK)
            places.append(at[own])
            grams.append(hashes[at[own] - lo] >> np.uint64(64 - HASH_BITS))
        at = np.concatenate(places)
        return at, np.searchsorted(self.ends, at, side="right"), np.concatenate(grams)


def _by_bucket(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of sorted hashes begins, and the end."""
    edges = (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << HASH_BITS) // buckets)) if buckets > 1 else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def _distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and whether more than one owner has each."""
    order = np.lexsort((owners, hashes))
    h, o = hashes[order], owners[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(first):
        return h, np.zeros(0, bool)
    last = np.concatenate([first[1:], [len(h)]]) - 1
    return h[first], o[first] != o[last]


def _cells(block: _Block, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes before and from the given anchors on, zero outside their documents, and how many are inside."""
    before, after = block.length - K, block.length
    left = np.minimum(before, at - block.begins[row])
    right = np.minimum(after, block.ends[row] - at)
    cells = np.lib.stride_tricks.sliding_window_view(block.padded, before + after)[at]  # a copy
    cells[:, :before][np.arange(before)[None, :] < (before - left)[:, None]] = 0
    cells[:, before:][np.arange(after)[None, :] >= right[:, None]] = 0
    return cells, left, right


def _words(cells: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of integers, padded with zeros."""
    wide = np.zeros((len(cells), -(-cells.shape[1] // 8) * 8), np.uint8)
    wide[:, : cells.shape[1]] = cells
    return wide.view("<u8")


def _hash(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    for column in words.T:
        start = _mix(start * _A + column * _B)
    return start


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1] if c.ndim == 1 else (c[1:] != c[:-1]).any(1)
    return new


def _counts(block: _Block, at: np.ndarray, row: np.ndarray, hashes: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """How many entries the block has of each distinct hash; up to FEW anchors all count."""
    which = np.searchsorted(distinct, hashes)
    counts = np.bincount(which, minlength=len(distinct))
    often = np.flatnonzero(counts[which] > FEW)
    if len(often):
        cells, left, right = _cells(block, at[often], row[often])
        marks, of = _hash(_words(cells), (left << 8 | right).astype(np.uint64)), which[often]
        order = np.lexsort((marks, of))
        of = of[order]
        counts[of] = 0
        counts += np.bincount(of[_changes(of, marks[order])], minlength=len(distinct))
    return counts


def _entries(block: _Block, at: np.ndarray, row: np.ndarray) -> dict:
    """Sorted distinct (suffix, bytes before it) at the given anchors, with the smallest doc_id of each, the
    places of that document, and the cuts that the block's own documents decide."""
    before, after = block.length - K, block.length
    cells, left, right = _cells(block, at, row)
    width = -(-(after + 1 + before + 1) // 8) * 8
    keys = np.zeros((len(at), width), np.uint8)  # suffix, its length, the bytes before in reverse, their number
    keys[:, :after] = cells[:, before:]
    keys[:, after] = right
    keys[:, after + 1 : after + 1 + before] = cells[:, before - 1 :: -1] if before else 0
    keys[:, after + 1 + before] = left
    order = np.lexsort((at, block.numbers[row], *[keys[:, i : i + 8].copy().view(">u8").ravel() for i in range(width - 8, -1, -8)]))
    keys, at, row, left, right = keys[order], at[order], row[order], left[order], right[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]) if len(at) else np.zeros(0, bool)
    entry = np.cumsum(new) - 1
    ids = block.numbers[row]
    least = ids[new][entry] if len(at) else ids
    own = ids == least  # these wait for the answer; the others repeat a document of this block
    cut = ~own & (left + right >= block.length)
    return {"keys": keys[new], "left": left[new], "right": right[new], "ids": ids[new], "entry": entry[own], "at": at[own], "from": (at - left)[cut], "to": (at + right)[cut]}


def _runs(block: _Block, number: int, answers: pa.Table, buckets: int) -> pa.Table:
    """Front-coded runs of a block, one for each bucket, from the buckets' answers about its hashes."""
    at, row, hashes = block.anchors()
    distinct, _ = _distinct(hashes, row)
    edges = _by_bucket(distinct, buckets)
    shared_by_two, heavy = np.zeros(len(distinct), bool), np.zeros(len(distinct), np.uint64)
    for bucket, bits, sizes in zip(*(answers.column(x).to_pylist() for x in ("bucket", "bits", "heavy")), strict=True):
        a, b = edges[bucket], edges[bucket + 1]
        shared_by_two[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        if sizes:
            heavy[a:b] = _unpack(sizes)
    which = np.searchsorted(distinct, hashes)
    chosen = shared_by_two[which] if len(distinct) else np.zeros(0, bool)
    at, row, hashes, which = at[chosen], row[chosen], hashes[chosen], which[chosen]
    apart = heavy[which] > 0
    out = _windows(block, number, at[apart], row[apart], hashes[apart], heavy[which][apart])
    at, row, which = at[~apart], row[~apart], which[~apart]
    bucket_of = np.searchsorted(edges[1:-1], which, side="right")
    for bucket in np.unique(bucket_of).tolist():
        mine = bucket_of == bucket
        e = _entries(block, at[mine], row[mine])
        keys, right, left, after = e["keys"], e["right"], e["left"], block.length
        same = keys[1:, :after] != keys[:-1, :after]
        prefix = np.concatenate([[0], np.where(same.any(1), same.argmax(1), after)]) if len(keys) else np.zeros(0, np.int64)
        prefix = np.minimum(prefix, right)
        prefix[1:] = np.minimum(prefix[1:], right[:-1])
        rest = keys[:, :after][(np.arange(after)[None, :] >= prefix[:, None]) & (np.arange(after)[None, :] < right[:, None])].tobytes()
        before = keys[:, after + 1 : after + 1 + block.length - K]
        lefts = before[np.arange(before.shape[1])[None, :] < left[:, None]].tobytes()
        out.append({
            "bucket": bucket, "block": number, "prefix": _squeeze(prefix.astype(np.uint8).tobytes()), "size": _squeeze(right.astype(np.uint8).tobytes()), "rest": _squeeze(rest),
            "left": _squeeze(left.astype(np.uint8).tobytes()), "lefts": _squeeze(lefts), "ids": _pack(e["ids"].astype("<i8").view("<u8")),
            "entry": _pack(np.diff(e["entry"], prepend=0)), "at": _pack(e["at"]), "start": _pack(e["from"]), "stop": _pack(e["to"]),
        })
    return pa.Table.from_pylist(out, schema=_arrow(_RUN))


def _windows(block: _Block, number: int, at: np.ndarray, row: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> list[dict]:
    """Rows like runs, one for each group (a bucket below 0): the distinct windows around anchors of K-grams
    with very many entries (sizes), place by place, with the smallest doc_id of each and that document's
    windows; what the block's own documents decide is cut already."""
    out: list[dict] = []
    cut = [np.zeros(0, np.int64)]
    salts = (sizes + np.uint64(WINDOWS - 1)) // np.uint64(WINDOWS)
    salts = np.minimum(salts, np.uint64(1 << SALT_BITS))
    view = np.lib.stride_tricks.sliding_window_view(block.data, block.length)
    for back in range(block.length - K + 1):
        inside = (at - back >= block.begins[row]) & (at - back + block.length <= block.ends[row])
        place, ids = at[inside] - back, block.numbers[row[inside]]
        if not len(place):
            continue
        words = _words(view[place])
        salt = _hash(words, np.zeros(len(words), np.uint64)) % salts[inside]
        group = -1 - (((grams[inside] << np.uint64(8) | np.uint64(back)) << np.uint64(SALT_BITS)) | salt).astype(np.int64)
        order = np.lexsort((place, ids, *words.T, group))
        group, words, place, ids = group[order], words[order], place[order], ids[order]
        new = _changes(group, words)
        own = ids == ids[new][np.cumsum(new) - 1]
        cut.append(place[~own])
        edges = [*np.flatnonzero(_changes(group)).tolist(), len(group)]
        for a, b in zip(edges, edges[1:], strict=False):
            first, mine = np.flatnonzero(new[a:b]) + a, own[a:b]
            entry = (np.cumsum(new[a:b]) - 1)[mine]
            out.append({
                "bucket": int(group[a]), "block": number, "rest": _squeeze(words[first].view(np.uint8)[:, : block.length].tobytes()), "ids": _pack(ids[first].astype("<i8").view("<u8")),
                "entry": _pack(np.diff(entry, prepend=0)), "at": _pack(place[a:b][mine]), "start": b"", "stop": b"",
            })
    cuts = np.unique(np.concatenate(cut))
    if len(cuts):  # windows that touch or overlap are one piece
        far = np.flatnonzero(np.diff(cuts) > block.length)
        out[0] |= {"start": _pack(cuts[np.concatenate([[0], far + 1])]), "stop": _pack(cuts[np.concatenate([far, [len(cuts) - 1]])] + block.length)}
    return out


def _least(rows: pa.Table, length: int) -> pa.Table:
    """A group's answers: the windows that a smaller doc_id of another block has are cut."""
    _release()
    rows = rows.sort_by("block")
    ids = [_unpack(x).view("<i8") for x in rows.column("ids").to_pylist()]
    words = _words(np.frombuffer(b"".join(map(_expand, rows.column("rest").to_pylist())), np.uint8).reshape(-1, length))
    order = np.lexsort(words.T)
    new = _changes(words[order])
    numbers = np.concatenate(ids)
    least = np.empty_like(numbers)
    least[order] = np.minimum.reduceat(numbers[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = np.split(np.where(least < numbers, length, 0).astype(np.uint8), np.cumsum([len(x) for x in ids])[:-1])
    answers = [{**r, "lo": _squeeze(bytes(len(h))), "hi": _squeeze(h.tobytes())} for r, h in zip(rows.select(_CARRIED).to_pylist(), hit, strict=True)]
    return pa.Table.from_pylist(answers, schema=_arrow(_ANSWER))


def _arrow(names: tuple[str, ...]) -> pa.Schema:
    return pa.schema([(n, {"bucket": pa.int64(), "block": pa.int32()}.get(n, pa.binary())) for n in names])


def _sql(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} { {'bucket': 'long', 'block': 'int'}.get(n, 'binary')}" for n in names)


_RUN = ("bucket", "block", "prefix", "size", "rest", "left", "lefts", "ids", "entry", "at", "start", "stop")


def _strings(lengths: bytes, joined: bytes) -> Iterator[bytes]:
    at = 0
    for n in lengths:
        yield joined[at : at + n]
        at += n


def _resolve(group: list[tuple], length: int, out: list[tuple[bytearray, bytearray]]) -> None:
    """Furthest matches of suffixes that share a K-gram. group: (suffix, bytes before in reverse, doc_id,
    run, place in the run)."""
    least: dict[tuple[bytes, bytes], int] = {}
    for suffix, before, doc, _, _ in group:
        key = (suffix, before)
        if doc < least.get(key, doc + 1):
            least[key] = doc
    smallest = min(least.values())
    answers: dict[tuple[bytes, bytes], tuple[int, int]] = {}
    if len(least) <= 12:
        for (suffix, before), doc in least.items():
            lo = hi = 0
            if doc > smallest:
                for (other, other_before), other_doc in least.items():
                    if other_doc < doc:
                        to_right, to_left = shared(suffix, other, K), shared(before, other_before, 0)
                        if to_right + to_left >= length:
                            lo, hi = max(lo, to_left), max(hi, to_right)
            answers[suffix, before] = lo, hi
    else:  # place by place, so that a common K-gram costs its rows, not its pairs
        found: dict[tuple[bytes, bytes], list[int]] = {key: [] for key in least}
        for back in range(length - K + 1):
            ahead = length - back
            first: dict[tuple[bytes, bytes], int] = {}
            for (suffix, before), doc in least.items():
                if len(suffix) >= ahead and len(before) >= back:
                    key = (suffix[:ahead], before[:back])
                    if doc < first.get(key, doc + 1):
                        first[key] = doc
            for (suffix, before), doc in least.items():
                if len(suffix) >= ahead and len(before) >= back and first[suffix[:ahead], before[:back]] < doc:
                    found[suffix, before].append(back)
        answers = {key: (backs[-1], length - backs[0]) if backs else (0, 0) for key, backs in found.items()}
    for suffix, before, doc, run, place in group:
        lo, hi = answers[suffix, before]
        if doc > least[suffix, before] and len(suffix) + len(before) >= length:
            lo, hi = len(before), len(suffix)
        out[run][0][place], out[run][1][place] = lo, hi


def _merge(rows: pa.Table, length: int) -> pa.Table:
    """A bucket's answers: for each entry of each run the bytes to cut left and right of its anchor."""
    _release()
    runs = rows.sort_by("block").to_pylist()
    del rows
    decoded, lengths = [], []
    for r in runs:
        prefix, sizes = _expand(r.pop("prefix")), _expand(r.pop("size"))
        lengths.append(len(sizes))
        decoded.append(zip(prefix, _strings(bytes(s - p for s, p in zip(sizes, prefix, strict=True)), _expand(r.pop("rest"))), strict=True))
    lefts = [_strings(_expand(r.pop("left")), _expand(r.pop("lefts"))) for r in runs]
    ids = [map(int, _unpack(r.pop("ids")).view("<i8")) for r in runs]
    out = [(bytearray(n), bytearray(n)) for n in lengths]
    place = [0] * len(runs)
    group: list[tuple] = []
    text = b""
    for known, run, rest in merge_front_coded(decoded):
        if known < K and group:
            if len(group) > 1:
                _resolve(group, length, out)
            group = []
        text = text[:known] + rest
        group.append((text, next(lefts[run]), next(ids[run]), run, place[run]))
        place[run] += 1
    if len(group) > 1:
        _resolve(group, length, out)
    answers = [{"block": r["block"], "bucket": r["bucket"], "lo": _squeeze(bytes(a)), "hi": _squeeze(bytes(b)), "entry": r["entry"], "at": r["at"], "start": r["start"], "stop": r["stop"]} for r, (a, b) in zip(runs, out, strict=True)]
    return pa.Table.from_pylist(answers, schema=_arrow(_ANSWER))


_ANSWER = ("block", "bucket", "lo", "hi", "entry", "at", "start", "stop")
_CARRIED = ["block", "bucket", "entry", "at", "start", "stop"]


def _cut(block: _Block, answers: pa.Table) -> pa.Table:
    """Each row's removed runs and the bytes that stay."""
    depth = np.zeros(block.n + 1, np.int32)
    for r in answers.to_pylist():
        lo, hi = (np.frombuffer(_expand(r[x]), np.uint8).astype(np.int64) for x in ("lo", "hi"))
        entry, at = np.cumsum(_unpack(r["entry"]).astype(np.int64)), _unpack(r["at"]).astype(np.int64)
        if len(at):
            on = hi[entry] > 0
            np.add.at(depth, (at - lo[entry])[on], 1)
            np.add.at(depth, (at + hi[entry])[on], -1)
        np.add.at(depth, _unpack(r["start"]).astype(np.int64), 1)
        np.add.at(depth, _unpack(r["stop"]).astype(np.int64), -1)
    gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
    edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
    owner = np.searchsorted(block.ends, edge[::2], side="right")
    removed: list[list[dict]] = [[] for _ in block.ids]
    for row, a, b in zip(owner.tolist(), edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        while a < b:  # a run that goes on into the next document is one run in each
            end = min(b, int(block.ends[row]))
            if a < end:
                removed[row].append({"start": a - int(block.begins[row]), "end": end - int(block.begins[row])})
            a, row = end, row + 1
    kept = [block.data[a:b][~gone[a:b]].tobytes() for a, b in zip(block.begins.tolist(), block.ends.tolist(), strict=True)]
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array(block.sizes), "removed": pa.array(removed, spans), "kept": pa.array(kept, pa.binary())})


def _ask(block: _Block, number: int, buckets: int) -> pa.Table:
    """A block's distinct hashes for each bucket: which two of its documents have, how many entries each has."""
    at, row, hashes = block.anchors()
    distinct, many = _distinct(hashes, block.numbers[row])
    counts = _counts(block, at, row, hashes, distinct)
    edges = _by_bucket(distinct, buckets)
    parts = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if a < b]
    return pa.table({
        "bucket": pa.array([i for i, _, _ in parts], pa.int32()), "block": pa.array([number] * len(parts), pa.int32()),
        "hashes": pa.array([_pack(np.diff(distinct[a:b], prepend=np.uint64(0))) for _, a, b in parts], pa.binary()),
        "many": pa.array([np.packbits(many[a:b]).tobytes() for _, a, b in parts], pa.binary()),
        "counts": pa.array([_pack(counts[a:b]) for _, a, b in parts], pa.binary()),
    })


def _answer(rows: pa.Table, most: int) -> pa.Table:
    """For each block which of its hashes are in two documents or more, and the number of entries of those
    that have more than `most` (0 for others, nothing if there are none)."""
    sent = [np.cumsum(_unpack(x)) for x in rows.column("hashes").to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(s)).astype(bool) for x, s in zip(rows.column("many").to_pylist(), sent, strict=True)]
    hashes, counts = np.concatenate(sent), np.concatenate([_unpack(x) for x in rows.column("counts").to_pylist()])
    order = np.argsort(hashes, kind="stable")
    new = _changes(hashes[order])
    twice, heavy = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.uint64)
    twice[order] = ~new | ~np.append(new[1:], True)
    total = np.add.reduceat(counts[order], np.flatnonzero(new))
    heavy[order] = np.where(total > most, total, 0)[np.cumsum(new) - 1]
    ends = np.cumsum([len(s) for s in sent])[:-1]
    on = np.split(twice | np.concatenate(many), ends)
    return pa.table({
        "block": rows.column("block").combine_chunks(), "bucket": rows.column("bucket").combine_chunks(), "bits": pa.array([np.packbits(x).tobytes() for x in on], pa.binary()),
        "heavy": pa.array([_pack(x) if x.any() else b"" for x in np.split(heavy, ends)], pa.binary()),
    })


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 50, block_bytes: int = 4 << 20, most: int = 1 << 15) -> DataFrame:
    """(doc_id, n_bytes, removed spans in bytes, kept bytes) for every row."""
    if not K <= length <= 200:
        raise ValueError(f"length is between {K} and 200 bytes")
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).cast("binary").alias("text"))
    total = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(4, -(-total // block_bytes))
    buckets = max(4, blocks // 3)
    # one exchange of the texts, which all three readings of a block use
    dealt = source.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def ask(rows: pa.Table) -> pa.Table:
        _release()
        return _ask(_Block(rows, length), rows.column("block")[0].as_py(), buckets)

    def merge(rows: pa.Table) -> pa.Table:
        return (_least if rows.column("bucket")[0].as_py() < 0 else _merge)(rows, length)

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        _release()
        if not rows.num_rows:
            return pa.Table.from_pylist([], schema=_arrow(_RUN))
        return _runs(_Block(rows, length), rows.column("block")[0].as_py(), answers, buckets)

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        _release()
        return _cut(_Block(rows, length), answers)

    asked = dealt.groupBy("block").applyInArrow(ask, "bucket int, block int, hashes binary, many binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(lambda rows: _answer(rows, most), "block int, bucket int, bits binary, heavy binary")
    sent = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, _sql(_RUN))
    merged = sent.groupBy("bucket").applyInArrow(merge, _sql(_ANSWER))
    return dealt.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(cut, "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")
