"""Sequence packing by non-negative least squares.

A document of n ids gives full windows and a remainder.  Over the histogram
of remainders, shallow combinations of two or three lengths that fill a
window exactly are enumerated; non-negative least squares gives their repeat
counts, which are rounded down and kept within the histogram; whole
remainders go there.  The remainders left over are packed greedily, one
after the other, cut at window ends.  The last, partial window is cut into
powers of two, which need no padding.

Only (row, remainder) pairs are shuffled to number the documents of a
length, in salted groups; the plan depends on the histogram, whose size is
bounded by the window.  Ids are made once and kept as a written table; the
ids of a remainder are read again only by a join on its row.

Defined results: null text is empty (its only id is the end id); repeated
rows are packed one by one; an empty table gives no pieces; other columns
are never read; ``<|...|>`` strings in a text are ordinary text.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import keyed, shuffle_parts, written

WINDOW = 2048
END_ID = 1
#: Places of a worker's table of chunks met before; a chunk of at most
#: CHUNK_BYTES bytes and CHUNK_IDS ids is kept there until another one takes
#: its place, so the table takes 44 MB whatever the corpus.
PLACES_BITS = 20
CHUNK_BYTES, CHUNK_IDS = 64, 8
#: Rows whose ids are made before they are handed on.
ROWS = 1000
#: Lengths (the most frequent ones) from which combinations are enumerated.
PLAN_LENGTHS = 160
#: Combinations given to the least squares: every exact pair, then triples by
#: how many remainders they can use.
COMBINATIONS = 6000


#: Bytes that are white space by themselves; first bytes of longer white space.
_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
_LONG_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: The longer white space of the scheme's piece pattern (Unicode White_Space).
_SPACES = [x.encode() for x in "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"]
#: Signs that end a letter's piece and make one with all signs behind them (an
#: apostrophe could make a piece with letters).
_SIGN = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
#: A chunk that is one piece: letters of the Latin blocks.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: A place within a very long text where a chunk ends.
_CUT = re.compile(rb"[!-~](?=[ \t\n\r])")


def _byte_letters() -> dict[int, str]:
    """The byte-level scheme's letter for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}


_LETTERS = _byte_letters()


def _plain_bytes(tok) -> bool:
    """Whether the tokenizer is the byte-level scheme and nothing else, so
    that a word's ids are what its model gives for the word's bytes."""
    x = json.loads(tok.to_str())
    pre, model = x["pre_tokenizer"] or {}, x["model"]
    plain = pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
    more = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    return plain and not x["normalizer"] and not x["truncation"] and not x["padding"] and all(t["special"] for t in x["added_tokens"]) and model["type"] == "BPE" and not any(model.get(k) for k in more)


def _latin_end(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a letter of the Latin blocks ends at each of the places."""
    last, lead = data[at], data[np.maximum(at - 1, 0)]
    two = (last >= 0x80) & (last < 0xC0) & ((lead > 0xC3) & (lead < 0xC9) | (lead == 0xC3) & (last != 0x97) & (last != 0xB7) | (lead == 0xC9) & (last < 0x90))
    return _LETTER[last] | two & (at > 0)


def chunk_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the chunks of a run of documents begin.

    Pieces of the byte-level scheme never have white space after a visible
    character, so a text may be encoded chunk by chunk, a chunk being a run
    of white space and the visible run after it.  A line end before a
    visible character and the signs behind a last letter are pieces of their
    own."""
    n = len(data)
    space = _SPACE[data]
    lead = np.flatnonzero(_LONG_SPACE[data])
    if len(lead):
        for size in (2, 3):
            at = lead[lead + size <= n]
            code = sum(data[at + k].astype(np.int64) << 8 * k for k in range(size))
            found = at[np.isin(code, [int.from_bytes(x, "little") for x in _SPACES if len(x) == size])]
            for k in range(size):
                space[found + k] = True
    first = np.zeros(n + 1, bool)
    first[offs] = True
    first[1:-1] |= space[1:] & ~space[:-1]
    start = np.flatnonzero(first[:-1])
    # a line end before a visible character of the same chunk
    line = start[data[start] == 10]
    line = line[line + 1 < n] + 1
    line = line[~space[line] & ~first[line]]
    # the signs at a chunk's end behind a letter
    other = np.flatnonzero(~_SIGN[data])
    end = np.append(start[1:], n)
    k = np.searchsorted(other, end) - 1
    last = other[np.maximum(k, 0)] if len(other) else np.zeros(len(end), np.int64)
    some = (k >= 0) & (last >= start) & (last < end - 1)
    last = last[some]
    first[line] = True
    first[last[_latin_end(data, last)] + 1] = True
    return np.flatnonzero(first[:-1])


class _Chunks:
    """Ids of texts by their chunks.  Of chunks met before they stand in a
    table with one place for each value of the hash's first bits."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model = self.tok.model if _plain_bytes(self.tok) else None
        self.hash = np.zeros(1 << PLACES_BITS, np.uint64)
        self.size = np.zeros(1 << PLACES_BITS, np.uint8)  # 0: free
        self.kept = np.zeros((1 << PLACES_BITS, CHUNK_IDS), np.uint32)

    def _encoded(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if self.model is not None and _WORD.fullmatch(text):
            return [x.id for x in self.model.tokenize(raw.decode("latin-1").translate(_LETTERS))]
        return self.tok.encode(text, add_special_tokens=False).ids

    def run(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by document) of a run of documents."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        start = chunk_starts(data, offs)
        end = np.append(start[1:], len(data))
        own = T.span_hash(T.prefix_hash(data), start, end)
        place = (own >> np.uint64(64 - PLACES_BITS)).astype(np.int64)
        rows, size = self.kept[place], self.size[place].astype(np.int64)
        miss = np.flatnonzero((self.hash[place] != own) | (size == 0) | (end - start > CHUNK_BYTES))
        long: dict[int, list[int]] = {}  # by number of the chunk
        if len(miss):
            short = miss[end[miss] - start[miss] <= CHUNK_BYTES]
            hashes, one, of = np.unique(own[short], return_index=True, return_inverse=True)
            one = short[one]
            raw = data.tobytes()
            ids = [self._encoded(raw[a:b]) for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)]
            n = np.array([len(x) for x in ids], np.int64)
            new = np.zeros((len(ids), CHUNK_IDS), np.uint32)
            fits = n <= CHUNK_IDS
            new[np.arange(CHUNK_IDS) < np.where(fits, n, 0)[:, None]] = [i for x in ids if len(x) <= CHUNK_IDS for i in x]
            rows[short], size[short] = new[of], n[of]
            for k in np.flatnonzero(~fits[of]).tolist():
                long[int(short[k])] = ids[int(of[k])]
            for k in miss[end[miss] - start[miss] > CHUNK_BYTES].tolist():
                long[k] = self._encoded(raw[start[k]:end[k]])
                size[k] = len(long[k])
            at, k = np.unique(place[one[fits]], return_index=True)  # one chunk for a place
            self.hash[at], self.size[at], self.kept[at] = hashes[fits][k], n[fits][k], new[fits][k]
        by = np.zeros(len(start) + 1, np.int64)
        np.cumsum(size, out=by[1:])
        if long:
            out = np.empty(by[-1], np.uint32)
            brief = np.ones(len(start), bool)
            brief[list(long)] = False
            out[np.repeat(brief, size)] = rows[brief][np.arange(CHUNK_IDS) < size[brief, None]]
            for k, x in long.items():
                out[by[k]:by[k + 1]] = x
        else:
            out = rows[np.arange(CHUNK_IDS) < size[:, None]]
        return out, by[np.searchsorted(start, offs)]

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian uint32 bytes; null: none."""
        data, offs = T.utf8(column)
        for i, j in T.slices(offs):
            own, at = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            if len(own) > 2 * T.SLICE_BYTES:  # one long text, by parts that end with a chunk
                yield b"".join(self.run(x, np.array([0, len(x)]))[0].astype("<u4").tobytes() for x in _parts(own))
                continue
            ids, by = self.run(own, at)
            ids = ids.astype("<u4", copy=False)
            for a, b in zip(by[:-1].tolist(), by[1:].tolist(), strict=True):
                yield ids[a:b].tobytes()

    def ids(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.large_string())))


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    raw, at = data.tobytes(), 0
    while at < len(raw):
        cut = _CUT.search(raw, at + T.SLICE_BYTES)
        end = cut.end() if cut else len(raw)
        yield data[at:end]
        at = end


_KEPT: dict[str, _Chunks] = {}


def _chunks(path: str) -> _Chunks:
    """The worker's table, which its later tasks go on using."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = _Chunks(path)
    return _KEPT[path]


def token_table(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(row_key, doc_id, doc_tokens, crcs of the full windows, crc and ids of
    the remainder), each document's ids made once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, end = _chunks(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in (b.slice(s, ROWS) for b in batches for s in range(0, b.num_rows, ROWS)):
            n, crcs, crc, rest = [], [], [], []
            for ids in chunks.texts(batch.column("text")):
                ids += end
                n.append(len(ids) // 4)
                full = len(ids) // (4 * window) * 4 * window
                crcs.append([zlib.crc32(ids[a:a + 4 * window]) for a in range(0, full, 4 * window)])
                crc.append(zlib.crc32(ids[full:]))
                rest.append(ids[full:])
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(crc, pa.int64()), pa.array(rest, pa.binary())], ["row_key", "doc_id", "doc_tokens", "crcs", "rest_crc", "rest"])

    return docs.mapInArrow(run, f"row_key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, doc_tokens long, crcs array<long>, rest_crc long, rest binary")


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min |a x - b| over x >= 0, by accelerated projected gradient steps."""
    x = y = np.zeros(a.shape[1])
    if not a.size:
        return x
    step, t = 1.0 / max(1e-9, np.abs(a).sum(0).max() * np.abs(a).sum(1).max()), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * (a.T @ (a @ y - b)))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


class Plan:
    """Repeat counts of the combinations for a histogram of remainders.

    ``first[c][slot]`` is the rank, among remainders of that length, at which
    combination c's slot begins; ranks from ``used[length]`` on are left over
    and lie one after the other in one stream."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW, lengths: int = PLAN_LENGTHS):
        self.window = window
        left = np.zeros(window + 1, np.int64)
        for r, c in counts.items():
            left[r] = c
        total = left.copy()
        self.used = np.zeros(window + 1, np.int64)
        self.slots: list[list[tuple[int, int, int, int]]] = [[] for _ in range(window + 1)]  # by length: (rank from, rank to, first sequence, offset)
        combos = self._combos(left, lengths)
        rows = sorted({r for c in combos for r in c})
        at = {r: k for k, r in enumerate(rows)}
        a = np.zeros((len(rows), len(combos)))
        for k, c in enumerate(combos):
            for r in c:
                a[at[r], k] += 1
        repeats = np.floor(nnls(a, left[rows].astype(float))).astype(np.int64) if combos else []
        self.sequences = 0
        for k in np.argsort(-np.asarray(repeats), kind="stable").tolist() if combos else []:
            need: dict[int, int] = {}
            for r in combos[k]:
                need[r] = need.get(r, 0) + 1
            n = int(min([repeats[k], *(left[r] // m for r, m in need.items())]))
            if n <= 0:
                continue
            offset = 0
            for r in combos[k]:
                self.slots[r].append((int(self.used[r]), int(self.used[r]) + n, self.sequences, offset))
                self.used[r] += n
                left[r] -= n
                offset += r
            self.sequences += n
        self.stream = np.zeros(window + 1, np.int64)  # where each length's left-over remainders begin
        self.stream[1:] = np.cumsum(left[:-1] * np.arange(window))
        self.stream_tokens = int((left * np.arange(window + 1)).sum())
        self.total = total

    def _combos(self, left: np.ndarray, lengths: int) -> list[tuple[int, ...]]:
        have = np.flatnonzero(left)
        have = have[have > 0]
        pairs = [(int(r), int(self.window - r)) for r in have if r <= self.window - r and left[self.window - r]]
        triples: dict[tuple[int, ...], int] = {}  # and how often the counts allow each
        often = sorted(have[np.argsort(-left[have], kind="stable")][:lengths].tolist())
        for i, r in enumerate(often):
            for s in often[i:]:
                t = self.window - r - s
                if t >= s and left[t]:
                    c = (r, s, t)
                    triples[c] = int(min(left[x] // c.count(x) for x in c))
        best = sorted(triples, key=lambda c: (-triples[c], c))
        return sorted(pairs + best[:max(0, COMBINATIONS - len(pairs))])

    def place(self, r: int, rank: int) -> tuple[list[tuple[int, int, int, int]], bool]:
        """Pieces (start in the remainder, length, sequence, offset) of the
        remainder with that rank; whether it is cut.  Sequences are counted
        from 0; the stream's come after the combinations'."""
        if rank < self.used[r]:
            for a, b, seq, off in self.slots[r]:
                if a <= rank < b:
                    return [(0, r, seq + rank - a, off)], False
        at = int(self.stream[r] + (rank - self.used[r]) * r)
        out, start = [], 0
        tail = self.stream_tokens // self.window * self.window
        while start < r:
            if at < tail:
                seq, off = divmod(at, self.window)
                n = min(r - start, self.window - off)
            else:  # the last window: powers of two from the largest down
                size, seq, off = self.stream_tokens - tail, tail // self.window, at - tail
                for bit in reversed(range(size.bit_length())):
                    if size >> bit & 1:
                        if off < 1 << bit:
                            break
                        off -= 1 << bit
                        seq += 1
                n = min(r - start, (1 << bit) - off)
            out.append((start, n, self.sequences + seq, off))
            start, at = start + n, at + n
        return out, len(out) > 1

    def stream_sequences(self) -> int:
        return self.stream_tokens // self.window + bin(self.stream_tokens % self.window).count("1")


def pack(documents: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = documents.sparkSession
    kind = documents.schema[id_col].dataType.simpleString()
    tokens = written(token_table(keyed(documents, id_col, text_col), tokenizer_path, window, end_id), "tokens")
    salts = shuffle_parts(spark)
    rests = tokens.select("row_key", "doc_id", "doc_tokens", "rest_crc", (F.col("doc_tokens") % window).cast("int").alias("r"), F.pmod(F.xxhash64("row_key"), F.lit(salts)).cast("int").alias("salt")).where("r > 0")
    # the rank of a remainder: its place in its salted group and what the earlier groups of its length hold
    counts = written(rests.groupBy("r", "salt").count(), "lengths")
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("r").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {x["r"]: x["n"] for x in counts.groupBy("r").agg(F.sum("count").alias("n")).collect()}  # at most `window` rows
    plan = Plan(histogram, window)
    shared = spark.sparkContext.broadcast(plan)
    ranked = rests.withColumn("k", F.row_number().over(Window.partitionBy("r", "salt").orderBy("row_key")) - 1).join(before.select("r", "salt", F.coalesce("before", F.lit(0)).alias("before")), ["r", "salt"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        names = ["row_key", "doc_id", "doc_tokens", "rest_crc", "at", "length", "sequence_id", "offset", "cut"]
        for batch in batches:
            out = []
            x = batch.to_pydict()
            for key, doc, n, crc, r, rank in zip(x["row_key"], x["doc_id"], x["doc_tokens"], x["rest_crc"], x["r"], x["rank"], strict=True):
                pieces, cut = p.place(r, rank)
                out += [(key, doc, n, crc, s, size, seq, off, cut) for s, size, seq, off in pieces]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            types = [pa.int64(), batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    placed = written(ranked.select("row_key", "doc_id", "doc_tokens", "rest_crc", "r", (F.col("k") + F.col("before")).cast("long").alias("rank")).mapInArrow(place, f"row_key long, doc_id {kind}, doc_tokens long, rest_crc long, at long, length long, sequence_id long, offset long, cut boolean"), "placed")
    start = (F.col("doc_tokens") - F.col("doc_tokens") % window + F.col("at")).alias("start")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = placed.where(~F.col("cut")).select("doc_id", start, "length", F.col("rest_crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    # a cut remainder lies across a window end: at most one for each window of the stream
    ids = tokens.select("row_key", "rest")
    cut = placed.where("cut").join(ids, "row_key").select("doc_id", start, "length", F.crc32(F.expr("substring(rest, int(at * 4) + 1, int(length * 4))")).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    # full windows: sequences after all others, numbered by groups of rows
    fulls = tokens.where(F.size("crcs") > 0).select("row_key", "doc_id", "doc_tokens", "crcs", F.shiftright("row_key", 33).alias("part"))
    per = fulls.groupBy("part").agg(F.sum(F.size("crcs")).alias("n"))
    base = per.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = fulls.withColumn("k", F.coalesce(F.sum(F.size("crcs")).over(Window.partitionBy("part").orderBy("row_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).join(base.select("part", "before"), "part")
    after = plan.sequences + plan.stream_sequences()
    full = numbered.select("doc_id", "doc_tokens", (F.col("k") + F.col("before") + after).alias("first"), F.posexplode("crcs").alias("i", "ids_crc32")).select("doc_id", (F.col("i") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("first") + F.col("i")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.select(out).unionByName(cut.select(out)).unionByName(full.select(out))
