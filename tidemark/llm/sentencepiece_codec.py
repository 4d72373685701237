"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text is marked (spaces become U+2581, one in front) and falls into marked words, which no
piece crosses. Each task sorts its distinct new words, which is a depth-first walk of their trie, and keeps
the forward table of the current path: a word computes only the places behind the prefix that it
shares with the word before.

What the table holds depends on the model. For a unigram model it is Viterbi's: the best score and the
piece that ends there. For a BPE model the best-scoring path is not the model's
encoding; there the entry is the last piece of the prefix's own encoding. It is the one piece that neither
merges with, nor is torn by, the last piece before it: merges never cross a border of
the final encoding, so a prefix that ends at a border is encoded alike by itself, and two neighbours
fit exactly if their joined text is encoded as these two. So the walk gives the library's ids.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship

ship(__name__)

MARK = "▁"
# Words whose pieces a task keeps between batches; beyond it the memory starts anew.
MEMO_WORDS = 500_000
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces, scores and byte pieces of a model, as plain picklable data."""

    def __init__(self, pieces: list[str], scores: list[float], special: list[bool], byte_ids: dict[int, int], unknown: int, kind: str):
        self.pieces, self.scores, self.special = pieces, scores, special
        self.byte_ids, self.unknown, self.kind = byte_ids, unknown, kind

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Vocabulary:
        """Read a model file, on the driver; ``kind`` is 'bpe' or 'unigram'."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        pieces = [sp.id_to_piece(i) for i in n]
        return cls(
            pieces,
            [sp.get_score(i) for i in n],
            [sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i) for i in n],
            {int(pieces[i][3:5], 16): i for i in n if sp.is_byte(i)},
            sp.unk_id(),
            kind,
        )

    def parts(self) -> tuple:
        return self.pieces, self.scores, self.special, self.byte_ids, self.unknown, self.kind


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.v = v
        self.ids = {p: i for i, p in enumerate(v.pieces) if not v.special[i]}
        self.score = {p: v.scores[i] for p, i in self.ids.items()}
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        newline = any("\n" in p for p in self.ids)
        # A piece across words, or with a line end, keeps these texts in one unit.
        if inner:
            self.unit = re.compile(r"(?s).+")
        elif newline:
            self.unit = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.unit = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        # Symbols: the pieces by id, then letters that occur in pieces only, then any other letter.
        self.names = list(v.pieces) + sorted({c for p in self.ids for c in p} - set(self.ids))
        symbol = {**self.ids, **{p: i for i, p in enumerate(self.names) if i >= len(v.pieces)}}
        self.other = len(self.names)
        self.names.append("?")
        self.symbol = symbol
        self.prefixes = {p[:k] for p in symbol for k in range(1, len(p) + 1)}
        # States of the walk: the longest end of the path that starts a piece, with the moves found
        # so far and the symbols that end there, longest first.
        self.states: dict[str, int] = {"": 0}
        self.state_text: list[str] = [""]
        self.moves: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.unknown_score = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.out: list[bytes] = []
        byte_of = {i: b for b, i in v.byte_ids.items()}
        for i, p in enumerate(v.pieces):
            if i in byte_of:
                self.out.append(bytes([byte_of[i]]))
            elif i == v.unknown:
                self.out.append(" ⁇ ".encode())
            else:
                self.out.append(b"" if v.special[i] else p.replace(MARK, " ").encode())

    # -- words -----------------------------------------------------------

    def _merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best-scoring neighbours merge, the leftmost first."""
        parts = list(text)
        get, none = self.score.get, float("-inf")
        gain = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while gain:
            best = max(gain)
            if best == none:
                break
            k = gain.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del gain[k]
            if k:
                gain[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(gain):
                gain[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def _fit(self, left: int, piece: int) -> bool:
        """Whether ``piece`` follows ``left`` (-1: the word's start) in an encoding."""
        a, b = self.names[left] if left >= 0 else "", self.names[piece]
        if left == self.other:
            got = self._merge(b) == [b]
        else:
            got = a + b not in self.score if a else True
            got = got and self._merge(a + b) == ([a, b] if a else [b])
        if len(self.fits) >= 4 * MEMO_WORDS:
            self.fits.clear()
        self.fits[(left + 1) << 32 | piece] = got
        return got

    def _ids_of(self, path: list[int], word: str) -> tuple[int, ...]:
        """Ids of a path of symbols; letters that are no piece become bytes, or the unknown piece."""
        n = len(self.v.pieces)
        if max(path) < n:
            return tuple(path)
        out, at = [], 0
        for i in path:
            size = 1 if i >= n else len(self.names[i])
            if i < n:
                out.append(i)
            else:
                raw = word[at].encode("utf-8", "replace")
                known = all(b in self.v.byte_ids for b in raw)
                out.extend((self.v.byte_ids[b] for b in raw) if known else (self.v.unknown,))
            at += size
        return tuple(out)

    def _move(self, state: int, letter: str) -> int:
        """The state after ``letter``, made when first met; there is one per start of a piece at most."""
        text = self.state_text[state] + letter
        while text and text not in self.prefixes:
            text = text[1:]
        new = self.states.get(text)
        if new is None:
            new = self.states[text] = len(self.state_text)
            self.state_text.append(text)
            self.moves.append({})
            tails = (text[k:] for k in range(len(text)))
            self.ends.append([(self.symbol[t], len(t)) for t in tails if t in self.symbol])
        if len(self.moves[state]) < 4096:  # texts may hold any letter
            self.moves[state][letter] = new
        return new

    def encode_words(self, words) -> None:
        """Put the ids of all ``words`` into the memory, walking their trie depth-first.

        Along the path, per place: the symbol that ends the prefix's encoding, its score (unigram), and
        the state, which tells the symbols that end there. Of these exactly one fits in a BPE
        encoding, so where no longer one does it is the letter itself.
        """
        fits, names, other = self.fits, self.names, self.other
        moves, ends = self.moves, self.ends
        bpe, scores, n = self.v.kind == "bpe", self.v.scores, len(self.v.pieces)
        last: list[int] = [-1]
        total: list[float] = [0.0]
        path_states: list[int] = [0]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], total[shared + 1 :], path_states[shared + 1 :]
            state, end = path_states[shared], shared
            for letter in word[shared:] if shared else word:
                end += 1
                after = moves[state].get(letter)
                state = after if after is not None else self._move(state, letter)
                found = other
                if bpe:
                    for symbol, size in ends[state]:
                        if size > 1:
                            left = last[end - size]
                            fit = fits.get((left + 1) << 32 | symbol)
                            if fit if fit is not None else self._fit(left, symbol):
                                found = symbol
                                break
                        else:
                            found = symbol
                else:
                    best = None
                    for symbol, size in ends[state]:
                        s = total[end - size] + (scores[symbol] if symbol < n else self.unknown_score)
                        if best is None or s > best:
                            best, found = s, symbol
                    s = total[end - 1] + self.unknown_score
                    if best is None or (s > best and ends[state][-1][1] > 1):
                        best, found = s, other
                    total.append(best)
                last.append(found)
                path_states.append(state)
            before = word
            path, end = [], len(word)
            while end:
                symbol = last[end]
                path.append(symbol)
                end -= len(names[symbol])
            path.reverse()
            self.memo[word] = self._ids_of(path, word)

    # -- texts -----------------------------------------------------------

    def marked(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        units = [self.unit.findall(self.marked(t or "")) for t in texts]
        new = set(chain.from_iterable(units))
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        self.encode_words(new.difference(self.memo))
        # Each distinct unit's ids once, then gathered in the units' order.
        place = {u: k for k, u in enumerate(new)}
        parts = [self.memo[u] for u in new]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(parts), dtype=np.int32, count=int(sizes.sum()))
        begins = np.concatenate([[0], sizes.cumsum()[:-1]]) if len(sizes) else sizes
        order = np.fromiter(map(place.__getitem__, chain.from_iterable(units)), dtype=np.int64, count=sum(map(len, units)))
        lengths = sizes[order]
        ends = lengths.cumsum()
        shift = np.repeat(begins[order] - (ends - lengths), lengths)
        ids = flat[shift + np.arange(len(shift))]
        per_text = np.array([len(u) for u in units], dtype=np.int64).cumsum()
        return ids, np.concatenate([[0], ends])[per_text]

    def decode(self, ids) -> str:
        """The text of ids; the space before the first word goes, bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.out.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ids (array of int) and n_tokens; with ``check`` also round_trip: whether
    decoding gives back the text (with U+2581 read as a space, as the marking does).

    Whole texts; a null or empty text has no ids. Input columns of these names give way.
    One pass without a shuffle; a task's memory is its word memory and a few hundred texts.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if check:
        new.append(T.StructField("round_trip", T.BooleanType()))
    taken = {f.name for f in new}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    base = docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = T.StructType(kept + new)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())

    def run(batches):
        codec = Codec(Vocabulary(*shared.value))
        for big in batches:
            for first in range(0, big.num_rows, 512):
                batch = big.slice(first, 512)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                flat, stops = codec.encode(texts)
                ends = np.concatenate([[0], stops]).astype(np.int32)
                cols = [batch.column(i) for i in range(batch.num_columns - 1)]
                cols += [pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))]
                if check:
                    back = (codec.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:]))
                    cols.append(pa.array([x == (t or "").replace(MARK, " ") for x, t in zip(back, texts)]))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in out.fields])

    return base.mapInArrow(run, out)


def decode_documents(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the decoded text of ``ids_col``; null ids give null, null elements are skipped."""
    kept = [f for f in docs.schema.fields if f.name.lower() != out_col.lower()]
    base = docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{ids_col}`").alias("__ids"))
    out = T.StructType(kept + [T.StructField(out_col, T.StringType())])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())

    def run(batches):
        codec = Codec(Vocabulary(*shared.value))
        for big in batches:
            for a in range(0, big.num_rows, 512):
                batch = big.slice(a, 512)
                lists = batch.column(batch.num_columns - 1).to_pylist()
                texts = [None if x is None else codec.decode([i for i in x if i is not None]) for x in lists]
                cols = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in out.fields])

    return base.mapInArrow(run, out)


MODEL = "/opt/tokenizers/piece_bpe_32k.model"
