"""Secret scans: base patterns, and a linear-chain conditional random field for what they miss.

Three base kinds are found by their patterns (fixed values below), leftmost and non-overlapping per kind. The field tags
tokens (runs of letters, digits, `+ / _ . -` and other characters) as begin, inside or outside of a secret from the
token's shape, its ends, the signs around it, the words before and after it, and the file's share of signs, digits and
assignments; Viterbi decodes whole texts. What its spans hold beside base spans is added as kind `crf` (pieces
without a letter or digit are left out); base spans always stay.

The field learns from the base spans of a bounded sample: about `SAMPLE_DOCS` texts by a hash of doc_id, and as many more
with base spans as make about `BASE_DOCS` of these (all, where there are fewer), of each the
surroundings of `NEAR` spans and `FAR` other runs of `RUN_TOKENS` tokens spread over the text.

So that it does not learn the patterns alone, it also sees `VARIED` rewritten runs of that sample (`variants`): values that
copy only the length of a base value, drawn from other alphabets, named and introduced in other ways; and beside them
harmless values (the run's own words, numbers, dates, versions, paths) behind the same names. A found span that opens right
after a quote runs on to the closing quote where no white space comes before it.

Defined results: a null or empty text has no spans; where nothing can be learned (no base span in the table) only base
spans are found; a very long text is searched whole, in one piece; repeated rows repeat their result, rows without a doc_id
are searched like others; of equally good taggings Viterbi takes the one with more outside; an empty table gives an empty
result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.crf import Model, viterbi
from tidemark.llm.texts import (
    NARROW_BYTES, ASCII_LOWER, U8, Slice, annotate, byte_class, fresh, give_back, map_batches, mix, run_hashes, slices, words)

# The kinds in their order, their patterns and least lengths (of group 2, or of the match).
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

SAMPLE_DOCS, BASE_DOCS, NEAR, FAR, RUN_TOKENS = 2000, 200, 4, 1, 48
VARIED, VARIED_TOKENS, LONG_WORD = 7000, 16, 64
BUCKET_BITS = 16
OUT, BEGIN, IN = 0, 1, 2
FEATURES, EXACT = 16, [0, 1, 2, 7, 8, 10]

# Stems of words that name a credential, as a lexicon feature, and what rewritten runs are made of.
CUES = [b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"bearer", b"cred"]
CUE_REACH = 4
NAMES = ["password", "passwd", "pwd", "secret", "token", "api key", "apikey", "access key", "auth key", "credential", "passphrase"]
OWNERS = ["", "", "", "my ", "the ", "admin ", "db_", "app-", "SERVICE_", "user.", "x_"]
LINKS = ["=", ": ", " = ", ":", " := ", " ", " was ", " => ", "\t", ", ", " to "]
AROUND = [("", ""), ("", ""), ('"', '"'), ("'", "'"), ("`", "`"), ("[", "]"), ("", ";"), ("", ".")]
ALPHABETS = [
    string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_letters + string.digits, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits,
    string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_", string.ascii_letters + string.digits + "~!@#$%^&*-"]

_TOKEN = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF), (0x2B, 0x2B), (0x2D, 0x2F), (0x5F, 0x5F)])
_HEX = byte_class([(0x30, 0x39), (0x61, 0x66)])
_CLASSES = [byte_class([(0x30, 0x39)]), byte_class([(0x41, 0x5A)]), byte_class([(0x61, 0x7A)]), byte_class([(0x80, 0xFF)]), _HEX]
_ASSIGNS = byte_class([(0x3A, 0x3A), (0x3D, 0x3D)])
_SPACES = byte_class([(0x20, 0x20), (0x09, 0x0D)])
_SIGNS = byte_class([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])
_KIND = np.array([1, 2, 3, 4], np.int8) @ np.array(_CLASSES[:4], np.int8)
# Two classes in the halves of one number, so that one running sum counts both (a text has less than 2**32 bytes).
_PAIRS = [a.astype(U8) | b.astype(U8) << U8(32) for a, b in ((_CLASSES[0], _CLASSES[1]), (_CLASSES[2], _CLASSES[3]), (_HEX, _SPACES))]


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, kind number, start of the value) of all base matches, by start and kind."""
    found = [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _counts(part: Slice, table: np.ndarray) -> np.ndarray:
    """How many bytes of a class each text has."""
    return np.diff(np.searchsorted(np.flatnonzero(table[part.data]), part.off))


def _worth_a_search(part: Slice) -> np.ndarray:
    """Texts that may hold a base match: with an assignment sign, a long run of hex digits, or the access prefix."""
    off = part.off
    held = _counts(part, _ASSIGNS) > 0
    starts, ends, first = words(part, _HEX)
    long_runs = np.concatenate([[0], np.cumsum(ends - starts >= LEAST["hex"])])
    held |= long_runs[first[1:]] > long_runs[first[:-1]]
    raw = part.data.tobytes()
    at = raw.find(b"AKIA")
    while at >= 0:
        held[np.searchsorted(off, at, "right") - 1] = True
        at = raw.find(b"AKIA", at + 1)
    return held


def _level(share: np.ndarray) -> np.ndarray:
    """0..7 by powers of two from 1/256 up."""
    return np.clip(np.log2(np.maximum(share, 1e-9)) + 8, 0, 7).astype(np.int64)


def file_code(part: Slice) -> np.ndarray:
    """A number for each text from its shares of signs, digits and assignment signs."""
    size = np.maximum(np.diff(part.off), 1)
    code = np.zeros(len(part), dtype=np.int64)
    for table in (_SIGNS, _CLASSES[0], _ASSIGNS):
        code = code * 8 + _level(_counts(part, table) / size)
    return code


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return (mix(h.astype(U8) * U8(0x9E3779B97F4A7C15) + U8(salt)) >> U8(64 - BUCKET_BITS)).astype(np.uint16)


def _named(part: Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The tokens that hold one of CUES, as numbers."""
    raw, found = ASCII_LOWER[part.data].tobytes(), []
    for stem in CUES:
        at = raw.find(stem)
        while at >= 0:
            found.append((at, at + len(stem)))
            at = raw.find(stem, at + 1)
    if not found or not len(starts):
        return np.zeros(0, np.int64)
    lo, hi = np.array(found).T
    own = np.searchsorted(starts, lo, "right") - 1
    return np.unique(own[(own >= 0) & (ends[own] >= hi)])


def token_features(part: Slice, files: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, first tokens and the feature buckets (FEATURES a token) of a slice."""
    data = part.data
    starts, ends, first = words(part, _TOKEN)
    n = ends - starts
    own = np.repeat(np.arange(len(part)), np.diff(first))
    shape = np.minimum(np.where(n < 12, n, 12 + np.log2(np.maximum(n, 1)).astype(np.int64)), 31)
    held = []
    total = np.zeros(len(data) + 1, dtype=U8)
    for pair in _PAIRS:
        np.cumsum(pair[data], out=total[1:])
        both = total[ends] - total[starts]
        held += [(both & U8(0xFFFFFFFF)).astype(np.int64), (both >> U8(32)).astype(np.int64)]
    for count in held[: len(_CLASSES)]:  # none, some, more than 3 of 10, all
        shape = shape * 4 + (count > 0) + (10 * count > 3 * n) + (count == n)
    kind = _KIND[data]
    turn = np.concatenate([[0, 0], np.cumsum(kind[1:] != kind[:-1], dtype=np.int32)])
    turns = np.minimum(turn[ends] - turn[starts + 1], 15) if len(starts) else n
    lower = run_hashes(ASCII_LOWER[data], starts, ends)
    none = U8(0)
    before, after = np.full_like(lower, none), np.full_like(lower, none)
    before[1:], after[:-1] = lower[:-1], lower[1:]
    begins = first[:-1][first[:-1] < len(starts)]
    before[begins] = none
    after[begins[begins > 0] - 1] = none
    padded = np.concatenate([np.full(2, 10, np.uint8), data, np.full(10, 10, np.uint8)])
    left = padded[starts + 1].astype(np.int64) * 256 + padded[starts]
    last_sign = padded[starts + 1].astype(np.int64)
    eight = np.ndarray((len(data) + 2,), dtype="<u8", buffer=padded, strides=(1,))
    head = eight[starts + 2] & (U8(1) << (U8(8) * np.minimum(n, 4).astype(U8))) - U8(1)
    tail = eight[np.maximum(ends - 2, starts) + 2] & U8(0xFFFF)
    s = shape.astype(U8)
    # Coarser than the shape, for lengths and mixtures that the sample lacks.
    mixture = ((shape >> 8) % 4 > 0) * 4 + ((shape >> 6) % 4 > 0) * 8 + ((shape >> 4) % 4 > 0) * 16 + np.minimum(turns // 2, 3)
    coarse = mixture * 8 + np.digitize(n, [4, 8, 12, 16, 32])
    # How far back (up to CUE_REACH tokens, 0: the token itself) a word names a credential, and what lies between two tokens.
    cue = np.full(len(starts) + CUE_REACH, CUE_REACH + 1, dtype=np.int64)
    named = _named(part, starts, ends)
    for back in range(CUE_REACH, -1, -1):
        cue[named + back] = back
    cue = np.where(cue[: len(starts)] <= np.arange(len(starts)) - first[own], cue[: len(starts)], CUE_REACH + 1)
    gap = np.full(len(starts), 3, dtype=np.int64)
    gap[1:] = np.minimum(starts[1:] - ends[:-1], 3)
    spaced = np.ones(len(starts), dtype=np.int64)
    spaced[1:] = total[starts[1:]] - total[ends[:-1]] >> U8(32) > 0  # the last pair's: white space
    spaced[begins], gap[begins] = 1, 3
    columns = [s, s * U8(16) + turns.astype(U8), lower, before, after, left, last_sign, head, tail * U8(8) + np.minimum(n, 7).astype(U8), mix(before ^ coarse.astype(U8)), files[own].astype(U8) * U8(1 << 20) + s, mixture, coarse, cue * 256 + coarse, (cue * 256 + coarse) * 8 + gap * 2 + spaced, (gap * 2 + spaced) * 256 + coarse]
    out = np.empty((len(starts), FEATURES), dtype=np.uint16)  # BUCKET_BITS
    for k, column in enumerate(columns):
        out[:, k] = _bucket(np.asarray(column).astype(U8), k + 1)
    return starts, ends, first, out


def emissions(model: Model, feature: np.ndarray) -> np.ndarray:
    total = np.take(model.weights, feature[:, 0], axis=0).astype(np.float64)
    for k in range(1, FEATURES):
        total += np.take(model.weights, feature[:, k], axis=0)
    return total


def _points(part: Slice, i: int) -> np.ndarray:
    """Code points before each byte of text i."""
    own = part.data[part.off[i] : part.off[i + 1]]
    return np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])


def _with_base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of texts and of those with a base span, slice by slice."""
    for batch in batches:
        for part in slices(batch.column(0), NARROW_BYTES):
            held = sum(1 for i in np.flatnonzero(_worth_a_search(part)) if base_spans(part.text(i).decode()))
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([held], pa.int64())], names=["n", "base"])


def _training_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of tokens of each text; of those marked in the second column only where they hold a base span."""
    for batch in batches:
        extra = batch.column(1).to_pylist()
        for part in slices(batch.column(0), NARROW_BYTES):
            starts, ends, first = words(part, _TOKEN)
            files, search = file_code(part), _worth_a_search(part)
            texts, codes = [], []
            for i in range(len(part)):
                a, b = int(first[i]), int(first[i + 1])
                if a == b:
                    continue
                spans = base_spans(part.text(i).decode()) if search[i] else []
                if extra[part.lo + i] and not spans:
                    continue
                at = {int(x) for x in np.linspace(a, max(a, b - RUN_TOKENS), FAR)}
                if spans:
                    point = _points(part, i)
                    for start, *_ in spans[:NEAR]:
                        near = int(np.searchsorted(starts[a:b], part.off[i] + np.searchsorted(point, start, "right") - 1)) + a
                        at.add(max(a, near - RUN_TOKENS // 2))
                for s in sorted(at):
                    texts.append(part.data[starts[s] : ends[min(s + RUN_TOKENS, b) - 1]].tobytes().decode())
                    codes.append(int(files[i]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(codes, pa.int64())], names=["text", "file"])


def _value(rnd: random.Random, size: int) -> str:
    """A value of `size` characters of one alphabet, at times with a prefix of its own or in groups."""
    letters = rnd.choice(ALPHABETS)
    value = "".join(rnd.choices(letters, k=size))
    if rnd.random() < 0.2:
        value = "".join(rnd.choices(string.ascii_lowercase, k=rnd.randint(2, 4))) + rnd.choice("_-") + value
    elif rnd.random() < 0.2:
        group = rnd.randint(4, 8)
        value = "-".join(value[i : i + group] for i in range(0, size, group))
    return value


def _harmless(rnd: random.Random, tokens: list[str]) -> str:
    """What stands where a value could and is none: the run's own words, alone or joined, numbers, dates, versions."""
    words = [rnd.choice(tokens) for _ in range(rnd.randint(1, 3))]
    number, day = rnd.randrange(10 ** rnd.randint(1, 7)), f"{rnd.randint(1900, 2040)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}"
    joined = [" ".join(words), " ".join(words), "-".join(words), "_".join(words), "/".join(words), "".join(w.title() for w in words), ".".join(words), words[0].upper(), words[0] + str(number), f"{words[0]}.{number}"]
    plain = [str(number), f"{number:,}", f"{number / 100}", day, f"{day}T{rnd.randint(0, 23):02}:{rnd.randint(0, 59):02}", f"v{rnd.randint(0, 30)}.{rnd.randint(0, 30)}.{number % 100}"]
    code = "".join(rnd.choices(string.ascii_uppercase, k=rnd.randint(1, 4)))
    plain += [f"{code}{number % 1000}", f"{code}-{number}", f"{code}_{day.replace('-', '')}_{number}.{words[-1][:3]}", f"{words[0]}_{day}.{words[-1][:3]}", f"{number % 100}{code[0].lower()}"]
    plain += [f"{plain[5]}-{words[0]}", f"{words[0]}-{number}.{words[-1][:3]}"]
    return rnd.choice(joined if rnd.random() < 0.4 else plain)


def variants(runs: list[tuple[str, int]], count: int = VARIED) -> list[tuple[str, int, list[tuple[int, int]]]]:
    """`count` pieces of runs (text, file) with rewritten secrets or harmless values put between two of their tokens, and
    where the secrets lie. Sizes are those of the runs' base values; half of the pieces hold a secret, all by one seed."""
    sizes = [end - value for text, _ in runs for _, end, _, value in base_spans(text)]
    rnd, out = random.Random(len(runs)), []
    while sizes and len(out) < count:
        text, file = rnd.choice(runs)
        spans = base_spans(text)
        pieces = [t for t in text.split() if len(t) <= LONG_WORD]
        tokens = [t for t in pieces if t.isalpha()] or ["word"]
        if spans:  # words only: what is left of a base span would be taken for harmless
            pieces = tokens
        near = rnd.randrange(len(pieces) + 1)
        before, after = pieces[max(0, near - VARIED_TOKENS // 2) : near], pieces[near : near + VARIED_TOKENS // 2]
        name = rnd.choice(NAMES)
        name = rnd.choice([name, name, name.upper(), name.replace(" ", "_"), name.title()])
        a, b = rnd.choice(AROUND)
        lead = rnd.choice(OWNERS) + name + rnd.choice(LINKS) + a
        secret = rnd.random() < 0.5
        if rnd.random() < (0.15 if secret else 0.5):
            lead = a
        value = _value(rnd, max(8, min(48, rnd.choice(sizes) + rnd.randint(-6, 6)))) if secret else _harmless(rnd, tokens)
        head = "".join(t + " " for t in before) + lead
        out.append((head + value + b + "".join(" " + t for t in after), file, [(len(head), len(head) + len(value))] if secret else []))
    return out


def _gold(part: Slice, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """The tag of each token, from the spans of each text in code points."""
    gold = np.zeros(len(starts), dtype=np.int64)
    for i, own in enumerate(spans):
        if not own:
            continue
        a, b = int(first[i]), int(first[i + 1])
        byte_of = np.flatnonzero(np.append((part.data[part.off[i] : part.off[i + 1]] & 0xC0) != 0x80, True))
        for value, end in own:
            lo, hi = part.off[i] + byte_of[value], part.off[i] + byte_of[end]
            at = np.flatnonzero((ends[a:b] > lo) & (starts[a:b] < hi)) + a
            gold[at] = np.where(gold[at] == BEGIN, BEGIN, IN)
            if len(at):
                gold[at[0]] = BEGIN
    return gold


def _learned_from(examples: list[tuple[str, int, list[tuple[int, int]]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and tags of all tokens of the examples (text, file, spans), and the first token of each; made slice by slice."""
    features, golds, begins, n = [np.zeros((0, FEATURES), np.uint16)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], 0
    for part in slices(pa.array([e[0] for e in examples]), limit=NARROW_BYTES):
        own = examples[part.lo : part.hi]
        starts, ends, first, feature = token_features(part, np.array([e[1] for e in own]))
        golds.append(_gold(part, starts, ends, first, [e[2] for e in own]))
        features.append(feature)
        begins.append(first[1:] + n)
        n += len(starts)
    return np.concatenate(features), np.concatenate(golds), np.concatenate(begins)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, rounds: int = 30, base_docs: int = BASE_DOCS) -> Model | None:
    """The field learned from a bounded sample of `docs` (doc_id, text); None where it holds no base span."""
    rows = docs.where(F.col("text").isNotNull())
    n, base = map_batches(rows.select("text"), _with_base, "n long, base long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("base"), F.lit(0))).first()
    if not base:
        return None
    share = min(1_000_000, 1_000_000 * sample_docs // max(n, 1) + 1)
    place = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000))
    sample = rows.where(place < max(share, min(1_000_000, 1_000_000 * base_docs // base + 1)))
    taken = map_batches(sample.select("text", (place >= share).alias("extra")), _training_runs, "text string, file long").toArrow()
    runs = sorted(zip(taken.column("text").to_pylist(), taken.column("file").to_pylist()))
    if not runs:
        return None
    examples = [(text, file, [(value, end) for _, end, _, value in base_spans(text)]) for text, file in runs] + variants(runs)
    feature, gold, first = _learned_from(examples)
    del taken, runs, examples
    if not gold.any():
        return None
    # Once more without what tells single tokens apart, so that contexts and coarse shapes carry weight of their own.
    blunt = feature.copy()
    blunt[:, EXACT] = 0
    feature, gold, first = np.concatenate([feature, blunt]), np.tile(gold, 2), np.concatenate([first, first[1:] + first[-1]])
    model = Model(1 << BUCKET_BITS, 3)
    model.fit(feature.reshape(-1), np.arange(len(gold) + 1) * FEATURES, np.arange(len(gold)), first, gold, rounds)
    model.transition[OUT, IN] = model.start[IN] = -30.0  # inside follows begin or inside only
    del feature, gold, first, blunt
    give_back()
    return model


def _beside(a: int, b: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What spans, ascending by start, leave of [a, b)."""
    left = []
    for x, y in spans:
        if a < y and x < b:
            if a < x:
                left.append((a, x))
            a = max(a, y)
    return [*left, (a, b)] if a < b else left


_QUOTES = {ord(q): re.compile(rb"[^\x20\x09-\x0D" + q.encode() + rb"]*" + q.encode()) for q in "\"'`"}


def _closing(part: Slice, i: int, start: int, end: int) -> int:
    """The end of a span of text i: that of its last token, or its closing quote if one opened right before it."""
    quote = _QUOTES.get(int(part.data[start - 1])) if start > part.off[i] else None
    held = quote and quote.match(part.data[end : part.off[i + 1]])
    return end + held.end() - 1 if held else end


def _spans_of(part: Slice, model: Model | None) -> list[list[tuple[int, int, str]]]:
    found: list[list[tuple[int, int, str]]] = [[] for _ in range(len(part))]
    for i in np.flatnonzero(_worth_a_search(part)):
        found[i] = [(a, b, KINDS[k]) for a, b, k, _ in base_spans(part.text(i).decode())]
    if model is None or not len(part.data):
        return found
    starts, ends, first, feature = token_features(part, file_code(part))
    if not len(starts):
        return found
    tags = viterbi(emissions(model, feature), first, model.transition, model.start)
    heads = np.flatnonzero(tags == BEGIN)
    text_of = np.searchsorted(first, heads, "right") - 1
    for i in np.unique(text_of):
        point = _points(part, i)
        base, rest = [(x, y) for x, y, _ in found[i]], []
        for h in heads[text_of == i]:
            last = h
            while last + 1 < first[i + 1] and tags[last + 1] == IN:
                last += 1
            a, b = int(point[starts[h] - part.off[i]]), int(point[_closing(part, i, int(starts[h]), int(ends[last])) - part.off[i]])
            pieces = _beside(a, b, base)
            if pieces != [(a, b)]:
                own = part.text(i).decode()
                pieces = [(x, y) for x, y in pieces if any(c.isalnum() for c in own[x:y])]
            rest += [(x, y, "crf") for x, y in pieces]
        found[i] += rest
        found[i].sort(key=lambda s: (s[0], [*KINDS, "crf"].index(s[2])))
    return found


SPANS = "array<struct<kind:string,start:long,end:long>>"


def scan(docs: DataFrame, model: Model | None, keep: list[str], name: str = "secret_spans") -> DataFrame:
    """`keep` of `docs` and all spans (kind, start, end) in code points, end exclusive, by start and kind."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: Slice) -> list[pa.Array]:
        rows = [[{"kind": k, "start": a, "end": b} for a, b, k in own] for own in _spans_of(part, sent.value)]
        return [pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]

    return annotate(docs, keep, T.StructType([T.StructField(name, T._parse_datatype_string(SPANS))]), run, limit=NARROW_BYTES)


def redacted(part: Slice, model: Model | None, mark: str = "[SECRET]") -> list[str]:
    out = []
    for i, own in enumerate(_spans_of(part, model)):
        text = part.text(i).decode()
        if own:
            pieces, at = [], 0
            for a, b, _ in own:
                if not pieces or a > at:
                    pieces += [text[at:a], mark]
                at = max(at, b)
            text = "".join([*pieces, text[at:]])
        out.append(text)
    return out


def redact(docs: DataFrame, model: Model | None, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark` (spans that meet become one); null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    clean = fresh("_clean", docs.columns)

    def run(part: Slice) -> list[pa.Array]:
        return [pa.array(redacted(part, sent.value, mark), pa.string())]

    found = annotate(docs, docs.columns, T.StructType([T.StructField(clean, T.StringType())]), run, limit=NARROW_BYTES)
    return found.withColumn("text", F.when(F.col("text").isNotNull(), F.col(clean))).select(*docs.columns)


def digest(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
