"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches

SPACE = "▁"
#: What an unknown character costs beyond the worst piece.
PENALTY = 10.0
#: Words whose pieces a worker remembers, and characters of them: twice as many at most.
REMEMBERED, REMEMBERED_CHARS = 400_000, 8_000_000


class Model:
    """The pieces of a model file: their scores, an automaton over them, and the bytes that each stands for."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [b""] * p.vocab_size()
        self.byte_ids = [0] * 256
        self.unknown = p.unk_id()
        self.automaton = ahocorasick.Automaton()
        self.scores = np.zeros(p.vocab_size())
        self.singles: set[str] = set()
        scores, inner = [], False
        for i in range(p.vocab_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes((value,))
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                scores.append(p.get_score(i))
                self.scores[i] = p.get_score(i)
                self.automaton.add_word(piece, (len(piece), p.get_score(i), i))
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                self.singles.update([piece] if len(piece) == 1 else [])
                inner |= bool(re.search(f"[^{SPACE}]{SPACE}", piece))
        self.automaton.make_automaton()
        self.fallback = any(self.byte_ids)
        self.unknown_score = min(scores) - PENALTY
        # No piece goes on over the end of a word, so words can be segmented one by one.
        self.words = re.compile(".+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.chars = 0

    def segment(self, word: str) -> list[int]:
        """The ids of the pieces with the largest sum of scores. Of equal sums, the longer last piece wins.

        The automaton gives at each position the pieces that end there, the longest first and then along its output
        links; each relaxes the best sum up to there. A character that is no piece can be skipped at a cost.
        """
        n = len(word)
        best, size, ident = [0.0] + [-float("inf")] * n, [0] * (n + 1), [-1] * (n + 1)
        odd = [k for k, c in enumerate(word) if c not in self.singles] if not self.singles.issuperset(word) else []
        todo = iter(odd + [n])
        skip = next(todo)
        for end, (length, score, i) in self.automaton.iter(word):
            while skip < end:
                if (total := best[skip] + self.unknown_score) > best[skip + 1]:
                    best[skip + 1], size[skip + 1], ident[skip + 1] = total, 1, -1
                skip = next(todo)
            if (total := best[end + 1 - length] + score) > best[end + 1]:
                best[end + 1], size[end + 1], ident[end + 1] = total, length, i
        while skip < n:
            if (total := best[skip] + self.unknown_score) > best[skip + 1]:
                best[skip + 1], size[skip + 1], ident[skip + 1] = total, 1, -1
            skip = next(todo)
        ids: list[int] = []
        at = n
        while at:
            if ident[at] >= 0:
                ids.append(ident[at])
            elif self.fallback:
                ids += [self.byte_ids[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(self.unknown)
            at -= size[at]
        return ids[::-1]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Words in use are remembered."""
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        wanted: set[str] = set()
        for words in split:
            wanted.update(words)
        known = self.known
        new = [w for w in wanted if w not in known]
        self.chars += sum(map(len, new))
        if len(known) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            known, self.before = {}, known
            self.known, new = known, list(wanted)
            self.chars = sum(map(len, new))
        before = self.before
        for w in new:
            ids = before.get(w)
            known[w] = array("i", self.segment(w)).tobytes() if ids is None else ids
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4") for words in split]

    def score(self, ids: np.ndarray) -> float:
        """The sum of the pieces' scores; bytes of unknown characters have none."""
        return float(self.scores[ids].sum())

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. A piece of the space sign is a space, and the one that encoding puts in front goes."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return raw[1 if raw[:1] == b" " else 0 :].decode("utf-8", "replace")


@cache
def model(path: str) -> Model:
    return Model(path)


def encoded(text: Column, path: str) -> Column:
    """text -> struct(ids, score, ids_crc32, round_trip). Null and empty texts have no ids."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            m, found = model(path), []
            texts = ["" if t is None else t for t in texts]
            for at in range(0, len(texts), 256):
                found += m.encode(texts[at : at + 256])
            same = [m.decode(x) == t.replace(SPACE, " ") for x, t in zip(found, texts, strict=True)]
            yield pd.DataFrame({"ids": found, "score": [m.score(x) for x in found], "ids_crc32": [zlib.crc32(x.tobytes()) for x in found], "round_trip": same})

    return F.pandas_udf(run, "ids array<int>, score double, ids_crc32 long, round_trip boolean")(text)


def decoded(ids: Column, path: str) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series(["" if x is None else model(path).decode(np.asarray(x, np.int32)) for x in some], dtype=object)

    return F.pandas_udf(run, "string")(ids)


def encode_decode(docs: DataFrame, path: str, *, text_col: str = "text") -> DataFrame:
    """Adds ids, score (the sum of the pieces' scores), ids_crc32, n_ids and round_trip (whether decoding gives the
    text again, the space sign counting as a space) to every row; columns of docs with these names are replaced.

    Null and empty texts have no ids, score zero, and come back as the empty text. Texts of any length are encoded whole, a word at a time where
    no piece goes over the end of a word, so a task's memory is a text and the words that it remembers. Of segmentations with one score the one with
    the longer last piece wins, so repeated rows have equal ids. An empty table gives no rows.
    """
    docs = small_batches(docs).drop("ids", "score", "ids_crc32", "n_ids", "round_trip")
    got = fresh(docs, "got")
    out = docs.withColumn(got, encoded(F.col(f"`{text_col}`"), path))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{got}.ids").alias("ids"), F.col(f"{got}.score").alias("score"), F.col(f"{got}.ids_crc32").alias("ids_crc32"), F.size(f"{got}.ids").cast("long").alias("n_ids"), F.col(f"{got}.round_trip").alias("round_trip"))
