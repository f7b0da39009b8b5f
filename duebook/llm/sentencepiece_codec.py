"""SentencePiece BPE, by a table of each prefix's last token.

In a byte-pair encoding every prefix of an encoded text ends in one token only: of the tokens
that match up to there, the one that is compatible with the last token of the prefix before it.
An automaton over all pieces gives the matches; a pair of tokens is compatible when the encoding
of the two strings joined is the two again; the ids come out backwards along the table. The cost
is linear in the text, whatever stands in it.

Texts are cut into units before a blank that follows something else: no piece of the model has a
blank behind another character (checked when a model is loaded; one that has is encoded as one
unit). Runs of blanks merge among themselves only after everything else, by equal scores, so a
unit is a run and a word. Units recur, and each worker remembers the ids of `MEMORY` of them.

A model with a normaliser is refused when it is loaded for encoding.

Decoding joins the pieces' texts, byte pieces as UTF-8, and takes off the one leading blank.

Cases. Null and empty texts are encoded as the end id alone and decode to an empty text. A
repeated row is encoded once per copy. An empty table gives an empty result. Other columns are
kept; a column that has the result's name is replaced.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from duebook.llm import common

BLANK = "▁"
#: Units and words whose ids a worker remembers, and pairs whose compatibility it does.
MEMORY, PAIRS = 600_000, 1_000_000

#: What stands between words that share a prefix table; no piece has it. Prefixes that no token
#: ends, and those that anything may follow.
SEP, NONE, FRESH = "\n", -1, -2

_models: dict = {}


def packed(ids: list[int]) -> bytes:
    """32-bit ids as bytes."""
    return array("i", ids).tobytes()


class Model:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)  # read for its table only
        # a normaliser would change such texts before they are encoded
        self.probes = {t: packed(sp.encode(t)) for t in ("ﬁ ①Ａ Å\u0301", "  a\u3000b\u00a0 c ", "\tA\u200b\n")}
        self.texts, self.scores, self.ids, self.bytes = [], [], {}, {}
        self.unknown = sp.unk_id()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.texts.append("" if sp.is_control(i) else piece.replace(BLANK, " "))
            self.scores.append(sp.get_score(i))
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
        self.texts[self.unknown] = " ⁇ "
        for b, i in self.bytes.items():
            if b < 0x80:  # a character of its own
                self.texts[i] = chr(b)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.parts_of_characters = {i for b, i in self.bytes.items() if b >= 0x80}
        self.automaton = None

    def prepare(self) -> None:
        """What only encoding needs."""
        import ahocorasick

        self.foreign = re.compile("[^%s]" % "".join(re.escape(c) for c in sorted({c for p in self.ids for c in p if p in self.ids and len(p) == 1}))).finditer
        self.cuttable = SEP not in "".join(self.ids) and not any(BLANK in p.lstrip(BLANK) or (p[0] == BLANK and p[1:2] == BLANK and p.strip(BLANK)) for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        # a character is there before any merge; the halves of a piece are those of its last merge
        best = sorted(set(self.scores), reverse=True)
        turn = {score: k for k, score in enumerate(best)}
        self.turns = {i: -1 if len(p) == 1 else turn[self.scores[i]] for p, i in self.ids.items()}
        words = [i for p, i in self.ids.items() if len(p) > 1 and p.strip(BLANK)]
        self.ordered = len({self.scores[i] for i in words}) == len(words)
        self.halves: dict[int, tuple[int, int]] = {}
        for piece, i in self.ids.items():
            if self.merged(piece, last := []) == [piece]:  # a piece that no merges lead to is never a token
                self.automaton.add_word(piece, (i, len(piece)))
                if last:
                    self.halves[i] = (self.ids[last[0]], self.ids[last[1]])
        self.automaton.make_automaton()
        self.piece = {i: p for p, i in self.ids.items()}
        self.pairs: list[dict[int, bool]] = [{} for _ in self.texts]
        self.asked = 0
        self.blank = packed([self.ids.get(BLANK, self.unknown)])
        self.joints = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.lengths = [len(p) for p in self.texts]
        self.units, self.known = common.Memory(MEMORY), common.Memory(MEMORY)
        self.unit = re.compile(f"{BLANK}+[^{BLANK}]*").findall if self.cuttable else (lambda t: [t])
        if self.encode(list(self.probes)) != list(self.probes.values()):
            raise ValueError("the model normalises texts, or merges by other rules than those built here")

    def merged(self, text: str, last: list | None = None) -> list[str]:
        """The pieces by merging itself: the best-scored pair first, the leftmost of equals.
        `last` takes the two that were merged last."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (k := self.ids.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.scores[k], i, j, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            if last is not None:
                last[:] = parts[i], parts[j]
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        row = self.pairs[a]
        ok = row.get(b)
        if ok is None:
            self.asked += 1
            if self.asked % PAIRS == 0:
                for known in self.pairs:
                    known.clear()
            pa_, pb = self.piece[a], self.piece[b]
            ok = row[b] = self.apart(a, b) if self.ordered else self.merged(pa_ + pb) == [pa_, pb]
        return ok

    def apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses from token a to token b: back through their merges, the latest
        first, the pieces that meet must make none that would have been merged before."""
        ids, piece, turns, halves = self.ids, self.piece, self.turns, self.halves
        limit = len(turns)
        while True:
            both = ids.get(piece[a] + piece[b])
            if both is not None and turns[both] < limit:
                return False
            if turns[a] > turns[b]:
                limit, a = turns[a], halves[a][1]
            elif b in halves:
                limit, b = turns[b] + 1, halves[b][0]
            else:
                return True

    def parts(self, word: str) -> list[str]:
        """A word cut where no merge can pass: between two characters that no piece has side by side."""
        if word[1:].isalpha():
            return [word]
        joints = self.joints
        cuts = [0, *[k for k in range(1, len(word)) if word[k - 1 : k + 1] not in joints], len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def words(self, texts: list[str]) -> list[bytes]:
        """The ids of words, by one prefix table over all of them; SEP keeps them apart."""
        text = SEP.join(texts)
        pairs, compatible, lengths = self.pairs, self.compatible, self.lengths
        last = [NONE] * (len(text) + 1)
        last[0] = FRESH
        for m in self.foreign(text):  # a character that no piece has: the next prefix starts afresh
            last[m.end()] = FRESH
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] < 0 and (p := last[end - length]) != NONE:
                if p >= 0:
                    ok = pairs[p].get(token)
                    if not (compatible(p, token) if ok is None else ok):
                        continue
                last[end] = token
        out, start = [], 0
        for t in texts:
            at, ids = start + len(t), []
            while at > start:
                if (i := last[at]) >= 0:
                    ids.append(i)
                    at -= lengths[i]
                else:
                    raw = text[at - 1].encode("utf-8")
                    ids.extend([self.bytes[x] for x in reversed(raw)] if self.bytes else [self.unknown])
                    at -= 1
            ids.reverse()
            out.append(packed(ids))
            start += len(t) + 1
        return out

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of units: a run of blanks, the last of which may go with the word behind it."""
        if not self.cuttable:
            return [packed([i for p in self.merged(u) for i in self.piece_ids(p)]) for u in units]
        words = [u.lstrip(BLANK) for u in units]
        parts = [self.parts(BLANK + w) for w in words]
        known = self.known.holding(set(chain.from_iterable(parts)), self.words)
        out = []
        for u, w, ps in zip(units, words, parts):
            run = len(u) - len(w)
            ids = known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])
            if run > 1:
                alone = ids[:4] == self.blank  # the word left its blank to the run
                ids = packed([i for p in self.merged(BLANK * (run if alone else run - 1)) for i in self.piece_ids(p)]) + ids[4 if alone else 0 :]
            out.append(ids)
        return out

    def piece_ids(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[x] for x in piece.encode("utf-8")] if self.bytes else [self.unknown]

    def encode(self, texts: list[str]) -> list[bytes]:
        """32-bit ids of texts."""
        if self.automaton is None:
            self.prepare()
        # the common case: single blanks between words; each unit is known by its word
        plain = [self.cuttable and BLANK not in t and "  " not in t and t[:1] != " " for t in texts]
        lists = [[] if not t else t.split(" ") if p else self.unit(BLANK + t.replace(" ", BLANK)) for t, p in zip(texts, plain)]

        def made(new: list[str]) -> list[bytes]:
            return self.encode_units([u if u[:1] == BLANK else BLANK + u for u in new])

        known = self.units.holding(set(chain.from_iterable(lists)), made)
        return [b"".join([known[u] for u in units]) for units in lists]

    def decode(self, ids: list[int]) -> str:
        texts, byte_of = self.texts, self.byte_of
        if self.parts_of_characters.isdisjoint(ids):
            text = "".join([texts[i] for i in ids])
        else:
            out, raw = [], bytearray()
            for i in ids:
                if i in byte_of:
                    raw.append(byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw = bytearray()
                out.append(texts[i])
            out.append(raw.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if text[:1] == " " else text


def model(path: str) -> Model:
    """One per worker process and file, so that its memory outlives a task."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encoded(path: str, end_id: int, text_col: str, out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, end = model(path), packed([end_id])
        for b in batches:
            blobs = [x + end for x in m.encode(common.strings(b, text_col))]
            offsets = np.zeros(len(blobs) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in blobs], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            yield common.with_columns(b, [(out_col, ids.type, ids)], drop=(out_col,))

    return run


def decoded(path: str, ids_col: str, out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        table = pa.array(m.texts)
        part = np.zeros(len(m.texts), bool)
        part[list(m.parts_of_characters)] = True
        for b in batches:
            lists = b.column(ids_col)
            if lists.null_count or lists.flatten().null_count:
                lists = pa.array([[i for i in x or [] if i is not None] for x in lists.to_pylist()], lists.type)
            ids = lists.flatten()
            ends = np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists), np.int64)))
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(ids)), "")
            texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
            # bytes of one character stand in pieces of their own: those rows go one by one
            odd = np.append(0, np.cumsum(part[np.asarray(ids)]))[ends]
            if odd[-1]:
                some = np.diff(odd) > 0
                whole = [m.decode(lists[i].as_py()) for i in np.flatnonzero(some).tolist()]
                texts = pc.replace_with_mask(texts, pa.array(some), pa.array(whole, pa.string()))
            yield common.with_columns(b, [(out_col, pa.string(), texts)], drop=(out_col,))

    return run


def widened(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, model_path: str, end_id: int = 2, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """`docs` with the ids of each text, the end id behind."""
    common.ready(docs.sparkSession)
    return docs.mapInArrow(common.unhurried(encoded(model_path, end_id, text_col, out_col)), widened(docs, out_col, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`df` with the text that each row's ids stand for."""
    common.ready(df.sparkSession)
    return df.mapInArrow(common.unhurried(decoded(model_path, ids_col, out_col)), widened(df, out_col, T.StringType()))
