"""N-best segmentation of texts over the lattice of a SentencePiece model, and decoding.

The given model is a BPE model: its scores are merge ranks, not log-probabilities.  The best path
by their sum is therefore not the library's encoding, which merges greedily by rank.  ``encoded``
without digests gives both: the library's own ids, and the N best paths beside them.

A text is read as the library reads it: one leading space, spaces written as U+2581.  No
ordinary piece holds that mark after its first character, so the lattice of a text is the chain
of its words' lattices (checked when a model is loaded).

* **Forward.** Viterbi scores of all new words of a block at once.
* **Backward.** For a word, A-star from its end: a partial path costs what it has plus the
  forward score of the place it has reached.  That is exact, so paths leave the queue in
  order and the first N are the N best.
* **Text.** Each word's best path is part of the best path of the text; of the others, only the
  N - 1 occurrences with the smallest loss can be part of the N best, so only these words are
  searched, and their losses are merged.

A character without a piece of its own is written as byte pieces, at a score below all others.
A literal U+2581 is written as bytes, so that decoding returns the text as it was.  Pieces that
the model marks as user-defined runs of spaces have no usable score: the single mark gets the
score of a character without a piece, longer runs are left out.

Defined cases: null and empty texts have no pieces, score 0 and one segmentation; a text with
fewer than N segmentations returns those it has; ties prefer the longer last piece.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.chunked import tokenizer

MARK = "▁"
N_BEST = 4
#: Words remembered by a Python worker; beyond it, it starts anew.
MEMO_WORDS = 400_000
#: Characters of new words in one forward pass.
PASS_CHARS = 150_000
_TABLE = 1 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """Pieces, scores and remembered words of one model."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        byte_ids = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(p[1:-1], 16)
                byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
                continue
            self.bytes_of.append(b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(MARK, " ").encode())
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.get_score(i) <= -1e8:
                continue
            if MARK in p[1:]:
                raise ValueError(f"Piece {p!r} joins words.")
            self.pieces[p] = (i, float(sp.get_score(i)))
        if len(byte_ids) < 256:
            raise ValueError("The model has no byte pieces.")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.below = min(s for _, s in self.pieces.values()) - 10.0
        lone = sp.piece_to_id(MARK)
        if not sp.is_unknown(lone):
            self.pieces[MARK] = (lone, self.below)
        self.longest = max(map(len, self.pieces))
        self._load_table()
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.score: list[float] = []
        self.gap: list[float] = []
        self.paths: dict[tuple[str, int], list] = {}

    def _load_table(self) -> None:
        """Open-addressed table: piece hash to id, looked up for whole arrays."""
        names = list(self.pieces)
        text = "".join(names)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        end = np.cumsum([len(x) for x in names])
        h = flat.span_hash(flat.prefix_hash(code), end - [len(x) for x in names], end)
        if len(np.unique(h)) != len(h):
            raise ValueError("Two pieces share a hash.")
        self.keys, self.at = np.zeros(_TABLE, np.uint64), np.full(_TABLE, -1, np.int32)
        self.reach = 1
        for i, x in enumerate(h.tolist()):
            slot, step = x % _TABLE, 1
            while self.at[slot] >= 0:
                slot, step = (slot + 1) % _TABLE, step + 1
            self.keys[slot], self.at[slot], self.reach = x, i, max(self.reach, step)
        self.piece_id = np.array([self.pieces[x][0] for x in names], np.int32)
        self.piece_score = np.array([self.pieces[x][1] for x in names])

    def _find(self, h: np.ndarray) -> np.ndarray:
        slot = (h % np.uint64(_TABLE)).astype(np.int64)
        out = np.full(len(h), -1, np.int32)
        for step in range(self.reach):
            here = (slot + step) & (_TABLE - 1)
            hit = (self.at[here] >= 0) & (self.keys[here] == h)
            out[hit] = self.at[here[hit]]
        return out

    def _single(self, c: str, first: bool) -> list[int]:
        """Ids of one character: its piece, or its bytes."""
        if not (c == MARK and not first) and c in self.pieces:
            return [self.pieces[c][0]]
        return [self.byte_ids[b] for b in c.encode("utf-8", "replace")]

    # forward, all words of a pass at once ------------------------------------------------

    def learn(self, words: list[str]) -> None:
        """Remember best path, score and loss of the second path for new words."""
        part, chars = [], 0
        for w in words:
            part.append(w)
            chars += len(w) + 1
            if chars >= PASS_CHARS:
                self._forward(part)
                part, chars = [], 0
        if part:
            self._forward(part)

    def _forward(self, words: list[str]) -> None:
        words = sorted(words, key=len)
        size = np.array([len(w) + 1 for w in words])
        code = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "replace"), np.uint32)
        total, n = len(code), len(words)
        base = np.cumsum(size) - size
        left = np.repeat(base + size, size) - np.arange(total)  # characters up to the word's end
        literal = code == ord(MARK)
        literal[base] = False
        p = flat.prefix_hash(code)
        bad = np.concatenate(([0], np.cumsum(literal)))
        score, ident = [], []
        for length in range(1, min(self.longest, int(size.max())) + 1):
            s, k = np.full(total, -np.inf), np.full(total, -1, np.int32)
            at = np.flatnonzero(left >= length)
            at = at[bad[at + length] == bad[at]]
            found = self._find(flat.span_hash(p, at, at + length))
            at, found = at[found >= 0], found[found >= 0]
            s[at], k[at] = self.piece_score[found], self.piece_id[found]
            if length == 1:
                s[k < 0] = self.below
            score.append(s)
            ident.append(k)
        # places 0..size of each word, one after another
        place = base + np.arange(n)
        ahead = np.full(total + n, -np.inf)
        took = np.zeros(total + n, np.int64)
        ahead[place] = 0.0
        for t in range(1, int(size[-1]) + 1):
            w = slice(int(np.searchsorted(size, t)), n)
            best, how = np.full(n - w.start, -np.inf), np.zeros(n - w.start, np.int64)
            for length in range(1, min(t, len(score)) + 1):
                value = ahead[place[w] + t - length] + score[length - 1][base[w] + t - length]
                better = value >= best
                best, how = np.where(better, value, best), np.where(better, length, how)
            ahead[place[w] + t], took[place[w] + t] = best, how
        behind = np.full(total + n, -np.inf)
        behind[place + size] = 0.0
        for t in range(1, int(size[-1]) + 1):
            w = slice(int(np.searchsorted(size, t)), n)
            from_ = size[w] - t
            best = np.full(n - w.start, -np.inf)
            for length in range(1, min(t, len(score)) + 1):
                best = np.maximum(best, behind[place[w] + from_ + length] + score[length - 1][base[w] + from_])
            behind[place[w] + from_] = best
        on = np.zeros(total + n, bool)
        at, live = size.copy(), np.arange(n)
        while len(live):
            on[place[live] + at[live]] = True
            at[live] -= took[place[live] + at[live]]
            live = live[at[live] > 0]
        top = ahead[place + size]
        word = np.repeat(np.arange(n), size)
        spot = np.arange(total) + word  # place of each character's start
        second = np.full(n, -np.inf)
        for length, s in enumerate(score, 1):
            i = np.flatnonzero(s > -np.inf)
            other = i[~(on[spot[i] + length] & (took[spot[i] + length] == length))]
            np.maximum.at(second, word[other], ahead[spot[other]] + s[other] + behind[spot[other] + length])
        ends = np.flatnonzero(on)
        owner = np.searchsorted(place, ends, "right") - 1
        length = took[ends]
        begin = ends - owner - length
        ids = np.array([k for k in ident])[length - 1, begin].astype(np.int32)
        cut = np.searchsorted(owner, np.arange(n + 1))
        missing = np.unique(owner[ids < 0])
        for i, w in enumerate(words):
            self.index[w] = len(self.ids)
            self.ids.append(ids[cut[i] : cut[i + 1]].tobytes())
        for i in missing.tolist():
            out = []
            for j in range(cut[i], cut[i + 1]):
                out += [int(ids[j])] if ids[j] >= 0 else self._single((MARK + words[i])[int(begin[j] - base[i])], begin[j] == base[i])
            self.ids[self.index[words[i]]] = np.array(out, np.int32).tobytes()
        self.score += top.tolist()
        self.gap += (top - second).tolist()

    # backward, one word ------------------------------------------------------------------

    def search(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The N best (score, ids) of one word, by A-star from its end."""
        if (word, n) in self.paths:
            return self.paths[word, n]
        s = MARK + word
        size = len(s)

        def edges_to(e: int):
            for b in range(max(0, e - self.longest), e):
                p = s[b:e]
                if p in self.pieces and not (MARK in p[1:] or (b and p[0] == MARK)):
                    yield b, self.pieces[p][1], (self.pieces[p][0],)
                elif e - b == 1:
                    yield b, self.below, tuple(self._single(p, b == 0))

        ahead = [0.0] + [-np.inf] * size
        for e in range(1, size + 1):
            ahead[e] = max(ahead[b] + v for b, v, _ in edges_to(e))
        queue = [(-ahead[size], 0, size, 0.0, None)]
        order, out = 1, []
        while queue and len(out) < n:
            f, _, at, g, path = heapq.heappop(queue)
            if at == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((-f, np.array(ids, np.int32).tobytes()))
                continue
            for b, v, ids in edges_to(at):
                heapq.heappush(queue, (-(g + v + ahead[b]), order, b, g + v, (ids, path)))
                order += 1
        if len(self.paths) > 50_000:
            self.paths.clear()
        self.paths[word, n] = out
        return out

    # texts -------------------------------------------------------------------------------

    def encode(self, texts: list[str], n: int) -> list[list[tuple[float, bytes]]]:
        """The N best (score, ids as little-endian int32) of each text, best first."""
        if len(self.index) > MEMO_WORDS:
            self.forget()
        split = [t.split(" ") if t else [] for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        self.learn([w for w in new if w not in self.index])
        out = []
        get, ids_of = self.index.__getitem__, self.ids
        score, gap = np.array(self.score), np.array(self.gap)
        for words in split:
            at = list(map(get, words))
            parts = [ids_of[i] for i in at]
            best = float(score[at].sum()) if at else 0.0
            found = [(best, b"".join(parts))]
            if n > 1 and at:
                loss = gap[at]
                few = np.argsort(loss, kind="stable")[: n - 1] if len(loss) <= n else np.sort(np.argpartition(loss, n - 1)[: n - 1])
                merged: list[tuple[float, tuple]] = [(0.0, ())]
                for k in few.tolist():
                    ways = self.search(words[k], n)
                    top = ways[0][0]
                    parts[k] = ways[0][1]
                    merged = sorted(
                        ((l + top - s, (*c, (k, ids))) for l, c in merged for s, ids in ways), key=lambda x: x[0]
                    )[:n]
                found = []
                for lost, changes in merged:
                    now = parts
                    if lost or found:
                        now = list(parts)
                        for k, ids in changes:
                            now[k] = ids
                    found.append((best - lost, b"".join(now)))
            out.append(found)
        return out

    def decode(self, ids: list[int]) -> str:
        body = b"".join(map(self.bytes_of.__getitem__, ids))
        return body[1:].decode("utf-8", "replace")


_LOADED: dict[str, Lattice] = {}


def lattice(model: str) -> Lattice:
    if model not in _LOADED:
        _LOADED[model] = Lattice(model)
    return _LOADED[model]


def _lists(rows: list[np.ndarray]):
    import pyarrow as pa

    cut = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))


def _rows(n: int, model: str | None, digests: bool):
    def run(batches):
        import pyarrow as pa

        path = model or default_model()
        lat = lattice(path)
        for batch in batches:
            for lo, hi, data, off in flat.blocks(batch.column("text")):
                body = data.tobytes()
                texts = [body[off[i] : off[i + 1]].decode("utf-8", "replace") for i in range(hi - lo)]
                found = lat.encode(texts, n)
                best = [np.frombuffer(f[0][1], np.int32) for f in found]
                scores = pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64()))
                same = pa.array([lat.decode(b.tolist()) == t for b, t in zip(best, texts)])
                keep = [c for c in batch.schema.names if c != "text"]
                given = [batch.column(c).slice(lo, hi - lo) for c in keep]
                if digests:
                    pieces = pa.array([len(b) for b in best], pa.int64())
                    sums = pa.array([[zlib.crc32(i) for _, i in f] for f in found], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*given, pieces, scores, sums, same], names=[*keep, "n_pieces", "scores", "ids_crc32", "round_trip"])
                else:
                    own = [np.frombuffer(b, np.int32) for b in tokenizer(path).encode(texts)]
                    pieces = pa.array([len(b) for b in own], pa.int64())
                    ways = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32))
                    paths = pa.ListArray.from_arrays(ways, _lists([np.frombuffer(i, np.int32) for f in found for _, i in f]))
                    yield pa.RecordBatch.from_arrays(
                        [*given, pieces, scores, _lists(own), paths, same], names=[*keep, "n_pieces", "scores", "ids", "paths", "round_trip"]
                    )

    return run


def encoded(docs: DataFrame, n: int = N_BEST, model: str | None = None, digests: bool = False) -> DataFrame:
    """Columns of ``docs`` but text, then number and ids of the library's pieces, scores and ids
    (``paths``) of the N best paths, and whether decoding the best path returned the text.

    With ``digests``, n_pieces is that of the best path, and the CRC-32 of each path stands for the ids.
    """
    others = [c for c in docs.columns if c != "text"]
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    kind = carried.schema["row"].dataType.simpleString()
    what = "ids_crc32 array<bigint>" if digests else "ids array<int>, paths array<array<int>>"
    out = carried.mapInArrow(_rows(n, model, digests), f"row {kind}, n_pieces bigint, scores array<double>, {what}, round_trip boolean")
    made = ["n_pieces", "scores", *(["ids_crc32"] if digests else ["ids", "paths"]), "round_trip"]
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in others if c not in made], *made)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_pieces, N best scores and id checksums, round_trip per row."""
    return encoded(docs.select("doc_id", "text"), digests=True)
