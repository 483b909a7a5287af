"""SentencePiece encoding and decoding over a streaming lattice.

The encoder walks a text once and keeps, for each of the last `longest piece`
positions, the best path that ends there.  Where the paths that can still grow
all lead back to one boundary, everything before it is final and is committed,
so the window, not the text, bounds what is held.

For a unigram model the best path is Viterbi's: the greatest sum of scores.
For a BPE model it is the one path whose neighbouring pieces byte-pair merging
would leave apart: each position then has exactly one last piece, and a piece
may follow another only if merging the two, taken back step by step, would never
have joined across their border.  Ids equal the library's in both cases.

No piece reaches over the start of a white-space run, over a line end or, for
most marks, from a mark to a letter, so all paths meet there whatever follows;
a text is walked from one such place to the next, and in front of the lattice
stands a memory of the stretches that a task has walked before.
"""

from __future__ import annotations

import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Pieces:
    """A parsed model file; small enough to travel with the tasks."""

    def __init__(self, blob: bytes, kind: int | None = None):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is are supported")
        self.kind = kind or proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is not supported")
        self.prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.index = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t in (NORMAL, USER)}
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.longest = max(map(len, self.index), default=1)
        self.floor = min((self.scores[i] for i in self.index.values()), default=0.0) - 10.0
        self.fine, self.coarse, self.mixed = self._cuts()
        self.split: dict[int, tuple[int, int]] = {}
        self.lattice = self.index
        if self.kind == BPE:
            self._splits()
        # The lattice's pieces by character: (piece or -1, what may follow).
        self.trie: dict = {}
        for piece, i in sorted(self.lattice.items()):
            at = self.trie
            for c in piece[:-1]:
                at = at.setdefault(c, (-1, {}))[1]
            at[piece[-1]] = (i, at[piece[-1]][1] if piece[-1] in at else {})

    def _cuts(self) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
        """Parts of a text between which every path has a boundary, for texts without and with exceptions, and what is one.

        No piece has white space after something else or holds a line end, and none joins a letter or digit and a
        mark, but for those with the exceptions.
        """
        never = re.compile(r"(?!)")
        if any(SPACE in p.lstrip(SPACE) for p in self.index):
            return re.compile(r"(?s).+"), re.compile(r"(?s).+"), never
        line = "" if any("\n" in p for p in self.index) else r"\n"
        last = rf"|{SPACE}+" + (r"|\n" if line else "")
        mixed = {x if x.isalnum() else y for p in self.index for x, y in zip(p, p[1:]) if SPACE not in (x, y) and x.isalnum() != y.isalnum()}
        fine = rf"{SPACE}*[^\W_]+|{SPACE}*(?:(?![{SPACE}{line}])[\W_])+" + last
        return re.compile(fine), re.compile(rf"{SPACE}*[^{SPACE}{line}]+" + last), re.compile(f"[{''.join(map(re.escape, sorted(mixed)))}]") if mixed else never

    def _splits(self) -> None:
        """The last merge of every piece; pieces that merging never makes leave the lattice."""
        keep = {}
        for piece, i in self.index.items():
            if len(piece) == 1 or set(piece) == {SPACE}:
                keep[piece] = i
                continue
            ids, last = self.merge(piece)
            if ids == [i]:
                keep[piece], self.split[i] = i, last
        self.lattice = {p: i for p, i in keep.items() if len(p) == 1 or p.strip(SPACE)}
        # Whether white space joins white space only after everything else has merged, and nothing else once it has.
        runs = [self.scores[i] for p, i in self.index.items() if len(p) > 1 and not p.strip(SPACE)]
        rest = [(p, self.scores[i]) for p, i in self.index.items() if len(p) > 1 and p.strip(SPACE)]
        self.spaces_last = SPACE in self.index and not any(SPACE in p[1:] for p, _ in rest) and (not runs or not rest or max(runs) < min(x for _, x in rest))
        # Singles come before every merge.
        self.rank = {i: -self.scores[i] if i in self.split else -1.0 for i in self.lattice.values()}

    def merge(self, s: str) -> tuple[list[int], tuple[int, int] | None]:
        """Byte-pair merging of a string as such, with its last merge; used for tables, white-space runs and tests."""
        symbols: list = list(s)
        after = list(range(1, len(s) + 1))
        before = list(range(-1, len(s) - 1))
        queue = []

        def offer(a: int) -> None:
            b = after[a]
            if b < len(symbols) and (i := self.index.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(queue, (-self.scores[i], a, symbols[a], symbols[b], b))

        for a in range(len(s) - 1):
            offer(a)
        last = None
        while queue:
            _, a, x, y, b = heapq.heappop(queue)
            if symbols[a] != x or after[a] != b or b >= len(symbols) or symbols[b] != y:
                continue
            last = (self.index.get(x, -1), self.index.get(y, -1))
            symbols[a], symbols[b], after[a] = x + y, None, after[b]
            if after[b] < len(symbols):
                before[after[b]] = a
            if before[a] >= 0:
                offer(before[a])
            offer(a)
        ids: list[int] = []
        for x in symbols:
            if x is not None:
                ids += [self.index[x]] if x in self.index else self.fallback(x)
        return ids, last

    def fallback(self, char: str) -> list[int]:
        raw = char.encode("utf-8", "replace")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]


class Encoder:
    """Streaming encoder of one task; remembers up to twice `remembered` parts, those used last."""

    def __init__(self, model: Pieces, remembered: int = 300_000):
        self.m = model
        self.most = remembered
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging leaves piece b apart from piece a before it."""
        known = self.apart.get(a << 24 | b)
        if known is not None:
            return known
        m = self.m
        left, right, limit, tie, ok = a, b, float("inf"), False, True
        pieces, rank, index, split, scores = m.pieces, m.rank, m.index, m.split, m.scores
        while True:
            joined = index.get(pieces[left] + pieces[right])
            # Would the two have been joined before the merge just taken back?  Of equal merges the left one goes first.
            if joined is not None and (-scores[joined] < limit or (tie and -scores[joined] == limit)):
                ok = False
                break
            ra, rb = rank.get(left, -1.0), rank.get(right, -1.0)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit, left, tie = ra, split[left][1], False
            else:
                limit, right, tie = rb, split[right][0], True
        if len(self.apart) > 600_000:
            self.apart.clear()
        self.apart[a << 24 | b] = ok
        return ok

    def _walk(self, s: str) -> list[int]:
        """The ids of a stretch by the lattice; what is held is a window of a few times the longest piece, committed as paths meet."""
        m, known, trie, longest = self.m, self.apart, self.m.trie, self.m.longest
        bpe, n, every = m.kind == BPE, len(s), 4 * m.longest
        out: list[int] = []
        base = j = 0  # the last committed boundary, and how far behind it the lattice has come
        size = min(n, every + longest)
        # By position since base: the last piece of the best path there (-3 none yet, -2 the start, -1 unknown), its start, score.
        last, back, best = [-2] + [-3] * size, [0] * (size + 1), [0.0] * (size + 1)
        w = s[:size] if size < n else s
        while True:
            stop = min(n - base, every)
            while j < stop:
                q, e, at = last[j], j, trie
                for c in w[j : j + longest]:
                    step = at.get(c)
                    if step is None:
                        break
                    e += 1
                    p, at = step
                    if p < 0:
                        continue
                    if not bpe:
                        x = best[j] + m.scores[p]
                        if last[e] == -3 or x > best[e]:
                            last[e], back[e], best[e] = p, j, x
                    elif last[e] == -3:
                        if q >= 0:
                            ok = known.get(q << 24 | p)
                            if not (self._stay_apart(q, p) if ok is None else ok):
                                continue
                        last[e], back[e] = p, j
                e = j + 1
                if last[e] == -3 or (not bpe and best[j] + m.floor > best[e]):
                    if w[j] not in m.index:
                        last[e], back[e], best[e] = -1, j, best[j] + m.floor
                    elif last[e] == -3:
                        raise AssertionError("a position without a path")
                j = e
            if base + j == n:
                self._commit(w, j, last, back, out)
                return out
            # The ends that a path can still grow from, followed back until one boundary is left.
            ends = {j, *(e for e in range(j + 1, min(j + longest, size + 1)) if last[e] != -3)}
            while len(ends) > 1:
                e = max(ends)
                ends.discard(e)
                ends.add(back[e])
            cut = ends.pop()
            if cut:
                self._commit(w, cut, last, back, out)
                last, back, best = last[cut:], [x - cut for x in back[cut:]], [x - best[cut] for x in best[cut:]]
                base, j, size = base + cut, j - cut, size - cut
            else:
                every += longest  # no boundary yet
            more = min(n - base, every + longest) - size
            last += [-3] * more
            back += [0] * more
            best += [0.0] * more
            size += more
            w = s[base : base + size]

    def _commit(self, s: str, end: int, last: list, back: list, out: list) -> None:
        """The ids of the path that ends there."""
        path = []
        while end > 0:
            path.append((last[end], end))
            end = back[end]
        for p, e in reversed(path):
            if p >= 0:
                out.append(p)
            else:
                ids = self.m.fallback(s[e - 1 : e])
                if ids != [self.m.unknown] or not out or out[-1] != self.m.unknown:
                    out += ids

    def part(self, s: str) -> list[int]:
        m = self.m
        if m.kind == BPE and len(s) > 1 and s[0] == SPACE == s[1]:
            word = s.lstrip(SPACE)
            if not word or SPACE in word or not m.spaces_last:
                return m.merge(s)[0]  # pieces of white space alone share one score, so only their order decides
            # The last space goes with the word if merging joins them; the run before it is merged apart.
            ids, n = self._walk(SPACE + word), len(s) - len(word)
            return m.merge(SPACE * n)[0] + ids[1:] if ids[0] == m.index[SPACE] else m.merge(SPACE * (n - 1))[0] + ids
        return self._walk(s)

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if not text:
            return b""
        seen = self.seen
        pattern = self.m.coarse if self.m.mixed.search(text) else self.m.fine
        parts = pattern.findall((SPACE if self.m.prefix else "") + text.replace(" ", SPACE))
        out = [seen.get(p) for p in parts]
        if None in out:
            for k, b in enumerate(out):
                if b is None:
                    p = parts[k]
                    b = seen.get(p)
                    if b is None:
                        b = self.before.get(p)
                        if b is None:
                            b = array("i", self.part(p)).tobytes()
                        if len(p) <= 64:
                            if len(seen) >= self.most:
                                self.before, self.seen = seen, {}
                                seen = self.seen
                            seen[p] = b
                    out[k] = b
        return b"".join(out)

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


class Decoder:
    """Ids back to text: pieces in order, byte pieces as bytes, the dummy prefix dropped."""

    def __init__(self, model: Pieces):
        self.prefix = model.prefix
        self.table = [
            bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE, " ").encode()
            for p, t in zip(model.pieces, model.types)
        ]

    def text(self, ids) -> str:
        raw = b"".join(map(self.table.__getitem__, ids))
        return (raw[1:] if self.prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


def load(path: str = MODEL, kind: int | None = None) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read(), kind)


def _slices(texts: pa.Array, most: int = 4 << 20):
    """(first, slice) of a string array, each of about `most` bytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield at, texts.slice(at, to - at)
        at = to


def encode(docs: DataFrame, model: Pieces, text: str = "text", checked: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in keep) in a struct `row`, then ids (array<int>), n_ids and, if checked, round_trip.

    round_trip says whether decoding the ids gives the text back.  A null text
    has null ids, n_ids and round_trip; an empty one no ids.  Repeated rows get
    the same ids; names of docs' columns can't clash as they stay in the struct.
    """
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text).alias("text"))

    def run(batches):
        encoder, decoder = Encoder(model), Decoder(model)
        for batch in batches:
            for at, slice_ in _slices(batch.column(1)):
                texts = slice_.to_pylist()
                got = [encoder.packed(s) if s is not None else None for s in texts]
                n = np.array([len(b) // 4 if b else 0 for b in got], np.int64)
                none = np.array([b is None for b in got], bool)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(n.sum()), [None, pa.py_buffer(b"".join(b for b in got if b))])
                ids = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(none, False)), values)
                out = [batch.column(0).slice(at, len(texts)), ids, pa.array(n, mask=none)]
                if checked:
                    out.append(pa.array([None if s is None else decoder.text(np.frombuffer(b, np.int32).tolist()) == s for s, b in zip(texts, got)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, names=["row", "ids", "n_ids", "round_trip"][: len(out)])

    return rows.mapInArrow(*_arrow.batches(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, n_ids bigint" + ", round_trip boolean" * checked))


def decode(encoded: DataFrame, model: Pieces, ids: str = "ids") -> DataFrame:
    """The columns of encoded in a struct `row`, then text; null ids give a null text, ids outside the model an error."""
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).alias("ids"))

    def run(batches):
        decoder = Decoder(model)
        for batch in batches:
            lists = batch.column(1)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            texts = [decoder.text(values[a:b].tolist()) if ok else None for a, b, ok in zip(offsets, offsets[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return rows.mapInArrow(*_arrow.batches(run, f"row {rows.schema['row'].dataType.simpleString()}, text string"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether decoding them gives the text back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, load(), checked=True, keep=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "n_ids", "ids", "round_trip")
