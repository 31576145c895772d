"""Language ID of every word of code-switched text, and of the text as a whole.

A linear-chain conditional random field labels the words (runs of ASCII letters and of bytes of other characters). A
word's features are its first and last one to four bytes (affixes), its 2- and 3-grams with its ends marked, and what the
lexicon of the training words says of it; transitions between labels are learned from chains that switch languages.
Forward-backward gives each word's probabilities; a text's language is the one with the largest mean over its words, and
that mean is its score. Only the text is looked at.

Training takes a bounded sample: `SAMPLE_DOCS` labelled texts a language (by a hash of doc_id), of each `SEGMENTS` runs
of `SEGMENT_WORDS` words spread over the whole text, spliced into chains of several languages.

Defined results: a null text and one without any letter is `und` with score 0, as is every text where nothing is
labelled; ties go to the first language in alphabetical order; repeated rows give repeated results; an empty table gives
an empty result; only `doc_id`, `text` and (for training) `lang` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.crf import Model, marginals
from tidemark.llm.texts import NARROW_BYTES, U8, Slice, annotate, byte_class, give_back, map_batches, mix, ranges, run_hashes, slices, words

SAMPLE_DOCS, SEGMENTS, SEGMENT_WORDS = 300, 4, 40
BUCKET_BITS = 17
UNKNOWN = "und"

_INSIDE = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_ASCII_LETTER = byte_class([(0x41, 0x5A), (0x61, 0x7A)])


def _lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the two-byte capital letters of Latin-1 in lower case."""
    out = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    if len(data) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:] += second * np.uint8(32)
    return out


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return (mix(h * U8(0x9E3779B97F4A7C15) + U8(salt)) >> U8(64 - BUCKET_BITS)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of words, one word's after the other, and where each word's begin. lexicon: a code for each word."""
    n = ends - starts
    wide = n + 2
    base = np.cumsum(wide) - wide
    buffer = np.zeros(int(wide.sum()) + 16, dtype=np.uint8)
    buffer[base] = 2
    buffer[base + n + 1] = 3
    buffer[np.repeat(base + 1, n) + ranges(n)] = data[np.repeat(starts, n) + ranges(n)]
    eight = np.ndarray((len(buffer) - 8,), dtype="<u8", buffer=buffer, strides=(1,))
    count = 9 + (n + 1) + n
    edges = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(int(edges[-1]), dtype=np.int64)
    at = edges[:-1]
    for k in range(1, 5):
        held = np.minimum(n, k)
        mask = (U8(1) << (U8(8) * held.astype(U8))) - U8(1)
        out[at + k - 1] = _bucket(eight[base + 1] & mask, 10 + k)
        out[at + 3 + k] = _bucket(eight[base + 1 + n - held] & mask, 20 + k)
    out[at + 8] = _bucket(lexicon.astype(U8), 30)
    two, three = ranges(n + 1), ranges(n)
    out[np.repeat(at + 9, n + 1) + two] = _bucket(eight[np.repeat(base, n + 1) + two] & U8(0xFFFF), 2)
    out[np.repeat(at + 10 + n, n) + three] = _bucket(eight[np.repeat(base, n) + three] & U8(0xFFFFFF), 3)
    return out, edges


def threes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 3-grams of words with their ends marked, as numbers of 24 bits, one word's after the other (a word of n bytes has n)."""
    inner = data.astype(np.int32)
    begin, end = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    begin[starts], end[ends - 1] = True, True
    at = np.repeat(starts, ends - starts) + ranges(ends - starts)
    before = np.where(begin[at], 2, inner[np.maximum(at - 1, 0)])
    after = np.where(end[at], 3, inner[np.minimum(at + 1, len(data) - 1)])
    return before | inner[at] << 8 | after << 16


@dataclass
class LanguageModel:
    labels: list[str]
    model: Model
    lexicon_keys: np.ndarray
    lexicon_codes: np.ndarray
    #: One bit for each 3-gram: whether the sample has it; and the share of one half's 3-grams that the other half has.
    threes: np.ndarray = field(default_factory=lambda: np.zeros(1 << 21, np.uint8))
    expected: float = 0.0

    def known(self, part: Slice) -> np.ndarray:
        """For each text the share of its words' 3-grams that the sample has, as a part of what is expected of a text in
        the learned languages (1 at most; 1 where nothing was learned or the text has no words)."""
        if not self.expected:
            return np.ones(len(part))
        data = _lower(part.data)
        starts, ends, first = words(part, _INSIDE, data)
        gram = threes(data, starts, ends)
        met = np.concatenate([[0], np.cumsum(self.threes[gram >> 3] >> (gram & 7).astype(np.uint8) & 1, dtype=np.int64)])
        at = np.concatenate([[0], np.cumsum(ends - starts)])[first]
        n = np.diff(at)
        return np.where(n > 0, np.minimum(np.diff(met[at]) / np.maximum(n, 1) / self.expected, 1), 1.0)

    def learn_threes(self, texts: list[str]) -> None:
        part = next(slices(pa.array(texts), limit=1 << 62))
        data = _lower(part.data)
        starts, ends, first = words(part, _INSIDE, data)
        gram = threes(data, starts, ends)
        held = np.zeros(1 << 24, dtype=bool)
        half = int((ends - starts)[: first[len(texts) // 2]].sum())
        held[gram[:half]] = True
        self.expected = float(held[gram[half:]].mean()) if half < len(gram) else 0.0
        held[gram] = True
        self.threes = np.packbits(held, bitorder="little")

    def codes(self, kinds: np.ndarray) -> np.ndarray:
        if not len(self.lexicon_keys):
            return np.zeros(len(kinds), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.lexicon_keys, kinds), len(self.lexicon_keys) - 1)
        return np.where(self.lexicon_keys[place] == kinds, self.lexicon_codes[place], 0)

    def words(self, part: Slice):
        """Starts, ends and first words of a slice's texts, its distinct words' features, and each word's kind."""
        data = _lower(part.data)
        starts, ends, first = words(part, _INSIDE, data)
        kinds, at, kind = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        feature, edges = features(data, starts[at], ends[at], self.codes(kinds))
        return starts, ends, first, kinds, kind, feature, edges

    def posteriors(self, part: Slice):
        starts, ends, first, _, kind, feature, edges = self.words(part)
        if not len(starts):
            return starts, ends, first, np.zeros((0, len(self.labels)))
        emission = self.model.emissions(feature, edges)[kind]
        return starts, ends, first, marginals(emission, first, self.model.transition, self.model.start)


def _segments(size: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for part in slices(batch.column(0), NARROW_BYTES):
                starts, ends, first = words(part, _INSIDE)
                lang, text = [], []
                for i in range(len(part)):
                    a, b = int(first[i]), int(first[i + 1])
                    for s in sorted({int(x) for x in np.linspace(a, max(a, b - size), number)}) if b > a else ():
                        lang.append(langs[part.lo + i])
                        text.append(part.data[starts[s] : ends[min(s + size, b) - 1]].tobytes().decode())
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(text, pa.string())], names=["lang", "text"])

    return run


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, rounds: int = 30) -> LanguageModel:
    """A model from the rows of `labelled` (doc_id, text, lang), null texts and languages left out."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1_000_000, 1_000_000 * sample_docs // n + 1))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < share) if counts else rows
    taken = map_batches(sample.select("text", "lang"), _segments(SEGMENT_WORDS, SEGMENTS), "lang string, text string").toArrow()
    pairs = sorted(zip(taken.column("lang").to_pylist(), taken.column("text").to_pylist()))
    labels = sorted(counts)
    known = {lang: k for k, lang in enumerate(labels)}
    model = LanguageModel(labels, Model(1 << BUCKET_BITS, max(1, len(labels))), np.zeros(0, U8), np.zeros(0, np.int64))
    if not pairs:
        return model
    order = np.random.default_rng(5).permutation(len(pairs))
    pairs = [pairs[i] for i in order]
    model.learn_threes([text for _, text in pairs])
    if len(labels) < 2:
        return model
    part = next(slices(pa.array([text for _, text in pairs]), limit=1 << 62))
    starts, ends, first, kinds, kind, _, _ = model.words(part)
    gold = np.repeat([known[lang] for lang, _ in pairs], np.diff(first))
    table = np.stack([np.bincount(kind, gold == k, minlength=len(kinds)) for k in range(len(labels))], axis=1)
    often = np.flatnonzero(table.sum(axis=1) >= 5)
    top = table[often].argmax(axis=1)
    rate = table[often].max(axis=1) / table[often].sum(axis=1)
    model.lexicon_keys = kinds[often]
    model.lexicon_codes = 1 + 3 * top + (rate > 0.6) + (rate > 0.9)
    _, _, _, _, kind, feature, edges = model.words(part)
    model.model.fit(feature, edges, kind, first[::3] if first[::3][-1] == first[-1] else np.append(first[::3], first[-1]), gold, rounds)
    del part, kind, feature, edges, gold
    give_back()
    return model


def label(docs: DataFrame, model: LanguageModel, keep: list[str], prefix: str = "", spans: bool = False, known: bool = False) -> DataFrame:
    """`keep` of `docs`, and with `prefix`: lang_pred, score, n_labelled (words) and n_switches (changes of the best label
    from word to word); with `known` the share of known 3-grams (see `LanguageModel.known`); with `spans` the runs of one language as (start, end, lang) in code points, end exclusive."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = f"`{prefix}lang_pred` string, `{prefix}score` double, `{prefix}n_labelled` long, `{prefix}n_switches` long"
    if known:
        fields += f", `{prefix}known` double"
    if spans:
        fields += f", `{prefix}lang_spans` array<struct<start:long,end:long,lang:string>>"

    def run(part: Slice) -> list[pa.Array]:
        held = sent.value
        starts, ends, first, gamma = held.posteriors(part)
        total = np.concatenate([np.zeros((1, gamma.shape[1])), np.cumsum(gamma, axis=0)])
        n = np.diff(first)
        mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None]
        best = gamma.argmax(axis=1)
        change = np.concatenate([[0], np.cumsum(best[1:] != best[:-1])]) if len(best) else np.zeros(1, np.int64)
        ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part.data])])
        lettered = ascii_letters[part.off[1:]] > ascii_letters[part.off[:-1]]
        for i in np.flatnonzero(~lettered & (n > 0)):
            lettered[i] = any(c.isalpha() for c in part.text(i).decode())
        told = lettered & bool(held.labels) & (n > 0)
        pred = [held.labels[k] if ok else UNKNOWN for k, ok in zip(mean.argmax(axis=1), told)]
        last = np.maximum(first[1:] - 1, first[:-1])
        switches = np.where(n > 0, change[np.minimum(last, len(change) - 1)] - change[np.minimum(first[:-1], len(change) - 1)], 0)
        made = [
            pa.array(pred, pa.string()), pa.array(np.where(told, np.clip(mean.max(axis=1), 0, 1), 0.0), pa.float64()),
            pa.array(np.where(told, n, 0), pa.int64()), pa.array(np.where(told, switches, 0), pa.int64())]
        if known:
            made.append(pa.array(held.known(part), pa.float64()))
        if spans:
            point = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
            rows = []
            for i in range(len(part)):
                a, b = int(first[i]), int(first[i + 1])
                if not told[i]:
                    rows.append([])
                    continue
                cuts = [a, *(np.flatnonzero(np.diff(best[a:b])) + a + 1), b]
                origin = point[part.off[i]]
                rows.append([{"start": int(point[starts[x]] - origin), "end": int(point[ends[y - 1]] - origin), "lang": held.labels[best[x]]} for x, y in zip(cuts, cuts[1:])])
            made.append(pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
        return made

    return annotate(docs, keep, T.StructType.fromDDL(fields), run, limit=NARROW_BYTES)
