"""Language ID by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased, everything that is no letter becomes one blank, and each character is
scored after the three before it. A model is a set of sorted hash arrays, one per order: the
hash of an n-gram finds its interpolated log probability in each language and, as a context, the
weight it leaves to the next lower order. The language of the lowest cross-entropy per character
wins. A text is rejected when it has no letter, or when that cross-entropy lies above a limit
calibrated on learning texts that the counts have not seen: the largest of theirs, and `margin`
nats beyond it, or half the way to what other languages' texts have at least where that is more.

Learning takes at most `per_lang` different texts of each language (those of the smallest hashes),
whole. Their n-grams are counted as Spark aggregates per language and n-gram; the driver gets the
counts, never the texts, and one number a calibrating text and language. Languages are the labels'
few names. Every text is scored whole, in one pass without a shuffle.

Cases. Null, empty and letterless texts are `und`, score 0, rejected. A null label teaches
nothing. Ties go to the language that sorts first. Repeated rows are scored once per copy. An
empty table, or one without labels, gives `und` for all. Other columns are kept; those named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm import common

ORDER = 4
#: What stands before a text, so that no character has another text's in its context: marks, and a
#: blank as before any word. Marks of texts that are scored are never those that were learned, so that
#: the first characters are scored after the blank alone.
LEAD = ORDER - 1
PRED = [("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("accepted", "boolean")]

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each 16-bit character whether it is a letter; the characters above count as letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000))
    return _letters[0]


def characters(texts: list[str], mark: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each behind two marks and a blank, and where those of each text start."""
    low = [t.lower() for t in texts]
    lead = " " * LEAD
    raw = np.frombuffer((lead + "".join(t + lead for t in low)).encode("utf-32-le", "replace"), "<u4")
    letter = letters()[np.minimum(raw, 0xFFFF)] | (raw > 0xFFFF)
    starts = np.cumsum([0] + [len(t) + LEAD for t in low])
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a blank stays behind a letter, runs of others do not
    keep[(starts[:, None] + np.arange(LEAD)).reshape(-1)] = True
    codes = np.where(letter, raw & 0xFFFF, 32)[keep].astype(np.uint64)
    starts = (np.cumsum(keep) - 1)[starts]
    codes[(starts[:, None] + np.arange(LEAD - 1)).reshape(-1)] = mark
    return codes, starts


def grams(codes: np.ndarray) -> np.ndarray:
    """At each place the last ORDER characters, 16 bits each, the newest lowest."""
    g = codes.copy()
    for k in range(1, ORDER):
        g[k:] |= codes[:-k] << np.uint64(16 * k)
        g[:k] |= np.uint64(32) << np.uint64(16 * k)
    return g


def lower(g: np.ndarray, n: int) -> np.ndarray:
    return g & np.uint64((1 << (16 * n)) - 1)


class Model:
    """tables[n]: sorted hashes of n-grams, their log probabilities and weights as a context."""

    def __init__(self, languages: list[str], tables: dict, floor: np.ndarray, limits: np.ndarray):
        self.languages, self.tables, self.floor, self.limits = languages, tables, floor, limits

    def logp(self, n: int, g: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.broadcast_to(self.floor, (len(g), len(self.languages)))
        keys, logp, _ = self.tables[n]
        at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        out = logp[at]
        miss = np.flatnonzero(keys[at] != g)
        if len(miss):
            rest = g[miss]
            out[miss] = self.left(n - 1, rest >> np.uint64(16)) + self.logp(n - 1, lower(rest, n - 1))
        return out

    def left(self, n: int, context: np.ndarray) -> np.ndarray:
        """Log of the weight that a context of n characters leaves to the lower order."""
        if n == 0:
            return np.broadcast_to(self.tables["empty"], (len(context), len(self.languages)))
        keys, _, bow = self.tables[n]
        at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
        return np.where((keys[at] == context)[:, None], bow[at], np.float32(0))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of each text in each language; how many characters were scored."""
        codes, starts = characters(texts)
        g = grams(codes)
        total = np.zeros((len(texts), len(self.languages)))
        starts, ends = starts[:-1] + LEAD, starts[1:]  # what stands before a text is context only
        step = 1 << 18
        n = ends - starts
        for a in range(0, len(codes), step):  # a bounded part of the batch at a time
            lp = self.logp(ORDER, g[a : a + step]).astype(np.float64)
            b = a + len(lp)
            inside = np.flatnonzero((starts < b) & (ends > a) & (n > 0))
            if len(inside):
                lo, hi = np.maximum(starts[inside], a) - a, np.minimum(ends[inside], b) - a
                c = np.vstack([np.zeros((1, lp.shape[1])), np.cumsum(lp, axis=0)])
                total[inside] -= c[hi] - c[lo]
        return total / np.maximum(n, 1)[:, None], n

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), bool)
        ce, n = self.entropies(texts)
        has = np.array([any(c.isalpha() for c in t) for t in texts], bool) & (n > 0)
        best = ce.argmin(axis=1)
        own = ce[np.arange(len(texts)), best]
        score = 1 / np.exp(-10 * (ce - own[:, None])).sum(axis=1)
        langs = [self.languages[i] if h else "und" for i, h in zip(best.tolist(), has.tolist())]
        return langs, np.where(has, score, 0.0), np.where(has, own, 0.0), has & (own <= self.limits[best])


def highest(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the highest order with their counts."""
    codes, starts = characters(texts, 0)
    keep = np.ones(len(codes), bool)
    keep[(starts[:, None] + np.arange(LEAD)).reshape(-1)] = False
    return np.unique(grams(codes)[keep], return_counts=True)


def orders(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """n-grams of each order with their counts: of the highest as they occur, of lower ones the
    number of different characters before them."""
    out = [(keys, counts)]
    for n in range(ORDER - 1, 0, -1):
        out.append(np.unique(lower(out[-1][0], n), return_counts=True))
    return out[::-1]


def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n of a batch of texts."""
    for b in batches:
        langs, texts = b.column("lang").to_pylist(), common.strings(b, "text")
        for lang in sorted(set(langs)):
            keys, n = highest([t for k, t in zip(langs, texts) if k == lang])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def modelled(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models from each language's n-grams of the highest order and their counts; no limits yet."""
    languages = sorted(counts)
    each = [orders(*counts[k]) for k in languages]
    alphabet = len(np.unique(np.concatenate([o[0][0] for o in each]))) + 1
    floor = np.full(len(languages), -np.log(alphabet), np.float32)
    tables: dict = {}
    model = Model(languages, tables, floor, np.full(len(languages), np.inf))
    for n in range(1, ORDER + 1):
        # contexts of the next order too: what stands before a text is no n-gram that is counted
        union = np.unique(np.concatenate([o[n - 1][0] for o in each] + [o[n][0] >> np.uint64(16) for o in each if n < ORDER]))
        logp = np.zeros((len(union), len(languages)), np.float32)
        bow_of_context = np.zeros((len(tables[n - 1][0]) if n > 1 else 1, len(languages)), np.float32)
        below = model.logp(n - 1, lower(union, n - 1))
        for k, o in enumerate(each):
            keys, counts = o[n - 1]
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            d = once / (once + 2 * twice) if once and twice else 0.5
            context = keys >> np.uint64(16)
            contexts, of = np.unique(context, return_inverse=True)
            total = np.bincount(of, counts)
            left = d * np.bincount(of) / total
            if n == 1:
                bow_of_context[0, k] = np.log(left[0])
            else:
                bow_of_context[np.searchsorted(tables[n - 1][0], contexts), k] = np.log(left)
            at = np.searchsorted(union, keys)
            seen = np.zeros(len(union))
            seen[at] = (counts - d) / total[of]
            spot = np.searchsorted(contexts, union >> np.uint64(16))
            spot = np.minimum(spot, len(contexts) - 1)
            weight = np.where(contexts[spot] == union >> np.uint64(16), left[spot], 1.0)
            logp[:, k] = np.log(seen + weight * np.exp(below[:, k]))
        if n == 1:
            tables["empty"] = bow_of_context[0]
        else:
            tables[n - 1] = (tables[n - 1][0], tables[n - 1][1], bow_of_context)
        tables[n] = (union, logp, np.zeros_like(logp))
    return model


def calibrated(model: Model, own: dict[str, float], others: dict[str, float], margin: float = 1.0) -> Model:
    """Limits of rejection: the largest cross-entropy of a language's texts, and `margin` nats, or
    half the way from there to the least of other languages' texts in it where that is more."""
    for k, lang in enumerate(model.languages):
        if lang in own:
            model.limits[k] = own[lang] + max(margin, (others.get(lang, own[lang]) - own[lang]) / 2)
    return model


def fit(samples: dict[str, list[str]], margin: float = 1.0) -> Model:
    """Models of the languages from texts in memory; every fifth only calibrates the limits."""
    samples = {k: v for k, v in samples.items() if characters(v)[0].size > LEAD * (len(v) + 1)}
    if not samples:
        return Model([], {}, np.zeros(0, np.float32), np.zeros(0))
    learn = {k: [t for i, t in enumerate(v) if i % 5 or len(v) < 5] for k, v in samples.items()}
    model = modelled({k: highest(v) for k, v in learn.items()})
    own, others = {}, {}
    for lang, v in samples.items():
        ce, n = model.entropies([t for i, t in enumerate(v) if i % 5 == 0])
        for k, name in enumerate(model.languages):
            for x in ce[n > 0, k].tolist():
                to, better = (own, max) if name == lang else (others, min)
                to[name] = better(to.get(name, x), x)
    return calibrated(model, own, others, margin)


def entropies_of(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            ce, n = model.entropies(common.strings(b, "text"))
            at = np.flatnonzero(n > 0)
            langs = np.asarray(b.column("lang").to_pylist(), object)[at]
            for k, name in enumerate(model.languages):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(langs == name), pa.array(ce[at, k])], names=["model", "own", "ce"])

    return run


def learned(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 500) -> Model:
    """A model from labelled rows, at most `per_lang` different texts of a language.

    Only some 4 * per_lang texts of a language are shuffled to be chosen from, whatever the table holds."""
    spark = common.ready(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text")
    )
    first = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 1), "h")
    some = common.thinned(rows, "lang", "h", per_lang).dropDuplicates(["lang", "h"])
    some = some.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang).withColumn("most", F.max("n").over(Window.partitionBy("lang")))
    # every fifth text calibrates, of a language with fewer than five also learns
    taken = common.settle(some.select("lang", "text", ((F.col("n") % 5 != 1) | (F.col("most") < 5)).alias("learns"), (F.col("n") % 5 == 1).alias("calibrates")), "learning")
    counts = taken.where("learns").select("lang", "text").mapInArrow(counting, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return Model([], {}, np.zeros(0, np.float32), np.zeros(0))
    langs, grams_of, n = counts["lang"].combine_chunks().dictionary_encode(), np.asarray(counts["gram"]).view(np.uint64), np.asarray(counts["n"])
    by: dict = {}
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        at = np.flatnonzero(np.asarray(langs.indices) == k)
        at = at[np.argsort(grams_of[at])]
        by[lang] = (grams_of[at], n[at])
    model = modelled(by)
    ce = taken.where("calibrates").select("lang", "text").mapInArrow(entropies_of(spark.sparkContext.broadcast(model)), "model string, own boolean, ce double")
    ends = ce.groupBy("model", "own").agg(F.max("ce").alias("most"), F.min("ce").alias("least")).collect()
    return calibrated(model, {r["model"]: r["most"] for r in ends if r["own"]}, {r["model"]: r["least"] for r in ends if not r["own"]})


def scored(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            out = model.predict(common.strings(b, text_col))
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield common.with_columns(b, [(name, kind, x) for (name, _), kind, x in zip(PRED, kinds, out)], drop=tuple(n for n, _ in PRED))

    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred, score, cross_entropy and accepted."""
    spark = common.ready(docs.sparkSession)
    names = {n for n, _ in PRED}
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names] + T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in PRED)).fields)
    return docs.mapInArrow(scored(spark.sparkContext.broadcast(model), text_col), schema)


def held_out(id_col: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id does not."""
    return F.coalesce(F.crc32(id_col.cast("string")) % mod == rest, F.lit(False))
