"""Language identification of mixed-language text: script ranges narrow the
candidates, each word is scored for each language, and Viterbi with a switching
penalty labels the words.

Scores are learned from all labelled documents it is given: counts of a word's
three-character pieces and of the word itself, in 2^16 classes per language
(256 KB a language in the broadcast model, whatever the size of the corpus)."""
from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "und"
CLASSES = 1 << 16
SWITCH = 10.0
OUTSIDE = -30.0
#: A script is a language's own from this share of its words.
LEAST_SHARE = 0.005
CHUNK_CHARS = 1 << 17
#: Words that are gone through one after another; blocks of them go side by side.
BLOCK = 64

# First code points of script ranges, and what they begin.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "odia"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_firsts = np.array([first for first, _ in SCRIPTS])
_names = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
_tables: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark that goes with one, else 0."""
    if not _tables:
        kinds = {"L": 2, "M": 1}
        _tables.append(np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8))
    return _tables[0]


class Chunk:
    """Words of some texts: row, letters, script and feature classes of each."""

    def __init__(self, texts: list[str | None]):
        lowered = [(t or "").lower() for t in texts]
        points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = letters()[points]
        inside = kind > 0
        edges = np.diff(np.concatenate([[0], inside.astype(np.int8)]))
        first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        has = np.add.reduceat(kind == 2, first) > 0 if len(first) else np.zeros(0, bool)
        first, end = first[has], end[has]
        ends_of_rows = np.cumsum([len(t) + 1 for t in lowered])
        self.row = np.searchsorted(ends_of_rows, first, "right")
        self.letters = end - first
        self.script = _names[np.searchsorted(_firsts, points[first], "right") - 1]
        # Pieces: the characters around each letter, a blank at the word's ends.
        p = np.where(inside, points, 32).astype(np.uint64)
        before, after = np.concatenate([[np.uint64(32)], p[:-1]]), np.concatenate([p[1:], [np.uint64(32)]])
        piece = (before * np.uint64(0x9E3779B97F4A7C15) ^ p * np.uint64(0xC2B2AE3D27D4EB4F)
                 ^ after * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
        # The word: its pieces together.
        sums = np.concatenate([[np.uint64(0)], np.cumsum(piece * piece)])
        word = (sums[end] - sums[first]) * np.uint64(0x9E3779B97F4A7C15)
        size = self.letters + 1
        self.starts = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(self.starts, size)
        source = np.repeat(first, size) + at
        last = at == np.repeat(self.letters, size)
        self.features = np.where(last, np.repeat(word, size), piece[np.minimum(source, len(piece) - 1)]) >> np.uint64(48)


def chunks(texts: list[str | None]):
    """(first row, Chunk) of about CHUNK_CHARS characters, by whole texts."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS or i == len(texts) - 1:
            yield first, i + 1, Chunk(texts[first:i + 1])
            first, size = i + 1, 0


def count(batches):
    """(lang, kind, class, n): features (kind 0) and scripts (1) of labelled rows,
    added up in the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        texts, langs = (batch.column(i).to_pylist() for i in (0, 1))
        for first, last, c in chunks(texts):
            names = langs[first:last]
            for lang in set(names):
                rows = np.array([x == lang for x in names])
                of = rows[c.row]
                f, s = sums.setdefault(lang, (np.zeros(CLASSES, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)))
                f += np.bincount(c.features[np.repeat(of, c.letters + 1)].astype(np.int64), minlength=CLASSES)
                s += np.bincount(c.script[of], minlength=len(SCRIPT_NAMES))
    for lang, tables in sums.items():
        for kind, t in enumerate(tables):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])],
                names=["lang", "kind", "class", "n"])


class Model:
    def __init__(self, counts: list):
        self.langs = sorted({r["lang"] for r in counts})
        at = {x: i for i, x in enumerate(self.langs)}
        features = np.zeros((CLASSES, len(self.langs)))
        scripts = np.zeros((len(SCRIPT_NAMES), len(self.langs)))
        for r in counts:
            (scripts if r["kind"] else features)[r["class"], at[r["lang"]]] = r["n"]
        self.scores = np.log((features + 0.5) / (features.sum(0) + 0.5 * CLASSES)).astype(np.float32)
        own = scripts >= LEAST_SHARE * np.maximum(scripts.sum(0), 1)
        own[~own.any(1)] = True  # nobody's script: any language
        self.outside = np.where(own, 0, OUTSIDE).astype(np.float32)


def fit(labelled: DataFrame) -> Model:
    """Model of rows (text, lang); rows without a lang teach nothing.  Counts are
    added up in Spark; 2^16 per language reach the driver."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang").mapInArrow(
        count, "lang string, kind int, class int, n long")
    return Model(rows.groupBy("lang", "kind", "class").agg(F.sum("n").alias("n")).collect())


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word; ``bounds`` are the texts' first words.

    A text keeps one language throughout where no stretch of words gains more
    than ``switch`` from another: then no other path can be better.  The others
    go by best_path()."""
    n, langs = scores.shape
    label = np.zeros(n, np.int64)
    counts = np.diff(bounds)
    full = np.flatnonzero(counts)
    if not len(full):
        return label
    doc = np.repeat(np.arange(len(counts)), counts)
    main = np.zeros(len(counts), np.int64)
    main[full] = np.add.reduceat(scores, bounds[:-1][full], axis=0, dtype=np.float64).argmax(1)
    label[:] = main[doc]
    over = np.zeros(len(counts), bool)
    for k in range(langs):
        gain = scores[:, k].astype(np.float64) - scores[np.arange(n), label]
        after = np.cumsum(gain)
        before = after - gain
        # Each text lies far below the one before it, so the least so far is its own.
        drop = doc * (np.abs(gain).sum() + 1.0) * 2
        best = after - drop - np.minimum.accumulate(before - drop)
        over[doc[best > switch]] = True
    todo = np.flatnonzero(over)
    if not len(todo):
        return label
    todo = todo[np.argsort(-counts[todo], kind="stable")]
    place, best = best_path(scores, bounds[:-1][todo], counts[todo], switch)
    label[place] = best
    return label


def best_path(scores: np.ndarray, first: np.ndarray, counts: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """Word places and their languages on the best paths of texts at ``first``, longest
    first.  Blocks of BLOCK words go side by side: once from each language they may be
    entered in, then, with the values they are entered with, again for the path."""
    langs = scores.shape[1]
    per = -(-counts // BLOCK)
    base, total = np.cumsum(per) - per, int(per.sum())
    within = np.arange(total) - np.repeat(base, per)
    place = np.repeat(first, per)[:, None] + within[:, None] * BLOCK + np.arange(BLOCK)
    real = place < np.repeat(first + counts, per)[:, None]
    # A missing word at a text's end scores 0 everywhere: the best language stays the best.
    grid = np.zeros((total, BLOCK, langs))
    grid[real] = scores[place[real]]
    gain = np.where(np.eye(langs, dtype=bool), 0.0, -np.inf) + np.zeros((total, 1, 1))
    for t in range(BLOCK):
        gain = np.maximum(gain, gain.max(2, keepdims=True) - switch) + grid[:, None, t]
    value = np.zeros((total, langs))
    alive = [int(np.searchsorted(-per, -b, "left")) for b in range(int(per[0]))]
    for b in range(1, int(per[0])):
        at = base[:alive[b]] + b
        value[at] = (value[at - 1][:, :, None] + gain[at - 1]).max(1)
    each = np.arange(total)
    back = np.empty((BLOCK, total, langs), np.int16)
    for t in range(BLOCK):
        top = value.argmax(1)
        leap = (value[each, top] - switch)[:, None]
        back[t] = np.where(value >= leap, np.arange(langs), top[:, None])
        value = np.maximum(value, leap) + grid[:, t]
    before = np.tile(np.arange(langs), (total, 1))
    for t in range(BLOCK - 1, -1, -1):
        before = np.take_along_axis(back[t], before, 1)
    now = value.argmax(1)  # of use for the last block of each text
    for b in range(int(per[0]) - 1, 0, -1):
        at = base[:alive[b]] + b
        now[at - 1] = before[at, now[at]]
    path = np.empty((total, BLOCK), np.int64)
    for t in range(BLOCK - 1, -1, -1):
        path[:, t] = now
        now = back[t][each, now]
    return place[real], path[real]


def label_words(c: Chunk, rows: int, model: Model, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """Label of each word, and the first word of each row."""
    bounds = np.searchsorted(c.row, np.arange(rows + 1))
    if not len(c.row):
        return np.zeros(0, np.int64), bounds
    scores = np.add.reduceat(model.scores[c.features.astype(np.int64)], c.starts, axis=0)
    return viterbi(scores + model.outside[c.script], bounds, switch), bounds


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` with _lang, _score (share of the letters in words of that language)
    and _spans (array of (lang, words): stretches of the text in order).

    Null texts and texts without a letter are ``und`` with score 0 and no span;
    so is every text if the model knows no language.  Ties go to the language
    that sorts first.  Older columns of these names are replaced."""
    docs = docs.drop("_lang", "_score", "_spans")
    known = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")
    schema = docs.withColumns({"_lang": F.lit(""), "_score": F.lit(0.0), "_spans": F.array().cast(
        "array<struct<lang:string,words:bigint>>")}).schema
    span = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def predict(batches):
        m = known.value
        for batch in batches:
            langs, shares, spans = [], [], []
            for first, last, c in chunks(batch.column(text_at).to_pylist()):
                n = last - first
                if not m.langs:
                    langs += [UNKNOWN] * n
                    shares += [0.0] * n
                    spans += [[]] * n
                    continue
                label, bounds = label_words(c, n, m, switch)
                of = np.bincount(c.row * len(m.langs) + label, c.letters, n * len(m.langs)).reshape(n, -1)
                best, total = of.argmax(1), of.sum(1)
                turn = np.flatnonzero((np.diff(label, prepend=-1) != 0) | (np.diff(c.row, prepend=-1) != 0))
                size = np.diff(np.append(turn, len(label)))
                turns = np.searchsorted(turn, bounds)
                for r in range(n):
                    langs.append(m.langs[best[r]] if total[r] else UNKNOWN)
                    shares.append(float(of[r, best[r]] / total[r]) if total[r] else 0.0)
                    spans.append([{"lang": m.langs[label[turn[i]]], "words": int(size[i])} for i in range(turns[r], turns[r + 1])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, span)],
                names=[*batch.schema.names, "_lang", "_score", "_spans"])

    return docs.mapInArrow(predict, schema)


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
