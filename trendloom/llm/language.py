"""Language of whole texts: script ranges, word scores, and Viterbi spans with a switching penalty.

Training counts character n-grams per language over a bounded sample of the labelled rows. A word's score
for a language is the sum of its n-grams' log probabilities. Languages that never use the word's script are
no candidates for it. The best labelling of a text's words maximises the sum of the scores less a penalty
for every switch of language, so a quotation in another language gets its own span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# N-grams of 1 to 3 characters share this many cells per language; with it the model has a fixed size.
CELLS = 1 << 15
ORDERS = (1, 2, 3)
# About so many labelled documents of each language, chosen by a hash of their ids, teach the model.
SAMPLE_PER_LANGUAGE = 3000
# A language is a candidate for a script that makes up this share of its letters or more.
SCRIPT_SHARE = 0.01
SWITCH_PENALTY = 12.0
# A single word can't differ by more than this between two languages, so one odd word makes no span.
WORD_LIMIT = 6.0
UNKNOWN = "und"
HELD_OUT = 2

# First code points of ranges and the script used there; fixed values of the Unicode standard.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

# Letters whose n-grams are held as arrays at a time; an array of them takes eight bytes a letter and n-gram order.
LETTERS_AT_ONCE = 1 << 16
# Words with known scores per task: so many, and so many bytes with their table, whatever the number of languages.
WORDS_KEPT, TABLE_BYTES = 300_000, 16 << 20

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return LETTERS.findall(text.lower()) if text else []


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of every n-gram of the words, the number of the word it is in, and the first script of each word."""
    joined = " " + " ".join(words) + " "
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    word = np.cumsum(space) - 1
    starts = np.flatnonzero(space)[:-1] + 1
    script = SCRIPT_OF_RANGE[np.searchsorted(SCRIPT_STARTS, points[starts].astype(np.int64), side="right") - 1]
    cells, owners = [], []
    for order in ORDERS:
        h = np.full(len(points) - order + 1, order, np.uint64)
        inside = np.ones(len(h), bool)
        for j in range(order):
            h = (h * np.uint64(0x9E3779B1) + points[j : len(points) - order + 1 + j]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(29)
            if 0 < j < order - 1:
                inside &= ~space[j : len(points) - order + 1 + j]
        if order == 1:
            inside = ~space
        elif order == 2:
            inside = ~(space[:-1] & space[1:])
        # An n-gram that begins with the space before a word, or ends with the one behind it, is the word's.
        at = np.arange(len(h))
        owner = np.where(space[at], word[at], word[at])
        cells.append((h % np.uint64(CELLS)).astype(np.int64)[inside])
        owners.append(owner[inside])
    return np.concatenate(cells), np.concatenate(owners), script


def portions(words: list[str], letters: int = LETTERS_AT_ONCE) -> Iterator[list[str]]:
    """The words in order, cut behind the word that reaches ``letters``; a word is never cut."""
    first = held = 0
    for k, word in enumerate(words):
        held += len(word) + 1
        if held >= letters:
            yield words[first : k + 1]
            first, held = k + 1, 0
    if first < len(words):
        yield words[first:]


@dataclass(frozen=True)
class LanguageModel:
    """``scores``: log probability of each cell by language; ``allowed``: candidates by script."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores of the words by language, relative to the best candidate and held within the limit."""
        return np.concatenate([self._portion_scores(part) for part in portions(words)])

    def _portion_scores(self, words: list[str]) -> np.ndarray:
        cells, owners, script = grams_of(words)
        total = np.zeros((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owners, self.scores[k][cells], minlength=len(words))
        possible = self.allowed[script]
        possible = possible | ~possible.any(axis=1, keepdims=True)
        total = np.where(possible, total, -np.inf)
        total -= total.max(axis=1, keepdims=True)
        none = ~self.allowed[script].any(axis=1)
        total[none] = 0.0
        return np.maximum(total, -WORD_LIMIT)


def training_part(doc_id: Column) -> Column:
    """True for the documents a model may learn from."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Learn from text and non-null ``lang`` of the rows that are not held out.

    The rows of each language are counted, and a hash of ``doc_id`` picks about
    ``sample_per_language`` of them, whole texts. Counts come back as one row per language and cell, at
    most languages times ``CELLS``. Without labelled rows the model has no language and every
    prediction is ``und``.
    """
    labelled = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & training_part(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel((), np.zeros((0, CELLS)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    bits = 1 << 20
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_per_language / n) * bits)])
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(bits))
    sample = labelled.where(place < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        import pyarrow as pa

        counted: dict[str, np.ndarray] = {}
        waiting: dict[str, list[str]] = {}
        letters: dict[str, int] = {}

        def add(lang, words):
            cells, _, script = grams_of(words)
            n = counted.setdefault(lang, np.zeros(CELLS + len(SCRIPT_NAMES), np.int64))
            n[:CELLS] += np.bincount(cells, minlength=CELLS)
            n[CELLS:] += np.bincount(script, minlength=len(SCRIPT_NAMES))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for words in portions(words_of(text.as_py())):
                    waiting.setdefault(lang, []).extend(words)
                    letters[lang] = letters.get(lang, 0) + sum(map(len, words))
                    if letters[lang] >= LETTERS_AT_ONCE:
                        add(lang, waiting.pop(lang))
                        letters[lang] = 0
        for lang, words in waiting.items():
            add(lang, words)
        for lang, n in counted.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                ["lang", "cell", "n"],
            )

    counts = sample.mapInArrow(count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    languages = sorted(sizes)
    table = np.zeros((len(languages), CELLS + len(SCRIPT_NAMES)))
    for r in counts.collect():
        table[languages.index(r["lang"]), r["cell"]] = r["n"]
    grams, scripts = table[:, :CELLS], table[:, CELLS:]
    scores = np.log((grams + 0.5) / (grams + 0.5).sum(axis=1, keepdims=True)).astype(np.float32)
    allowed = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= SCRIPT_SHARE).T
    return LanguageModel(tuple(languages), scores, allowed)


def best_labels(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Labels of the words that maximise the sum of their scores less ``penalty`` for each switch.

    A text that stays in one language throughout is recognised first: with ``best`` its best single
    language, no other language may gain more than the penalty on any stretch of words. A path with
    ``best`` in it pays one switch at least for every stretch in another language. A path without it has
    one switch less than stretches, so what a first and a last stretch gain together must not be more
    than the penalty either.
    """
    n, languages = scores.shape
    best = int(scores.sum(axis=0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, languages)), gain[:-1]]), axis=0)
    if (gain - lowest).max() <= penalty:
        others = np.delete(gain, best, axis=1)
        if n == 1 or languages == 1 or others[:-1].max() + (others[-1] - others[:-1]).max() <= penalty:
            return np.full(n, best)
    back = np.empty((n, languages), np.int16)
    stay = np.arange(languages)
    value = scores[0].copy()
    back[0] = stay
    for t in range(1, n):
        top = int(value.argmax())
        switch = value[top] - penalty
        moved = switch > value
        back[t] = np.where(moved, top, stay)
        value = np.where(moved, switch, value) + scores[t]
    labels = np.empty(n, np.int64)
    labels[-1] = value.argmax()
    for t in range(n - 1, 0, -1):
        labels[t - 1] = back[t, labels[t]]
    return labels


def label_text(model: LanguageModel, words: list[str], scores: np.ndarray) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Main language, its score, and spans (language, first word, number of words)."""
    if not words or not model.languages:
        return UNKNOWN, 0.0, []
    labels = best_labels(scores)
    letters = np.bincount(labels, [len(w) for w in words], minlength=len(model.languages))
    main = int(letters.argmax())
    total = scores[labels == main].sum(axis=0)
    certain = 1.0 / np.exp(np.minimum(total - total[main], 50.0)).sum()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
    spans = [(model.languages[labels[a]], int(a), int(b - a)) for a, b in zip(cuts[:-1], cuts[1:])]
    return model.languages[main], float(letters[main] / letters.sum() * certain), spans


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` with ``_lang_pred``, ``_lang_score`` and ``_lang_spans``.

    Only ``text`` is looked at, all of it. A null text, or one without a letter, is ``und`` with score 0
    and no spans. The score is the share of the letters that carry the main language, times its
    probability there among all languages. Ties go to the language that sorts first.
    """
    spans = T.ArrayType(
        T.StructType().add("lang", T.StringType()).add("first", T.IntegerType()).add("words", T.IntegerType())
    )
    schema = T.StructType([
        *docs.schema.fields, T.StructField("_lang_pred", T.StringType()), T.StructField("_lang_score", T.DoubleType()),
        T.StructField("_lang_spans", spans),
    ])

    def predict(batches):
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
        limit = min(WORDS_KEPT, TABLE_BYTES // (8 * max(1, len(model.languages))))
        known: dict[str, int] = {}
        table = np.empty((limit, len(model.languages)))
        for batch in batches:
            at_column = batch.schema.get_field_index("text")
            column = batch.column(at_column)
            for first in range(0, max(batch.num_rows, 1), 256):
                part = batch.slice(first, 256)
                if not part.num_rows:
                    continue
                texts = [words_of(x.as_py()) for x in column.slice(first, 256)]
                new = list(dict.fromkeys(w for words in texts for w in words if w not in known))
                if len(known) + len(new) > limit:
                    known, new = {}, list(dict.fromkeys(w for words in texts for w in words))
                    table = np.empty((max(limit, len(new)), len(model.languages)))
                if new and model.languages:
                    table[len(known) : len(known) + len(new)] = model.word_scores(new)
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                out = [
                    label_text(model, words, table[[known[w] for w in words]]) if words and model.languages
                    else (UNKNOWN, 0.0, []) for words in texts
                ]
                spans = [[{"lang": x, "first": a, "words": b} for x, a, b in o[2]] for o in out]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([o[0] for o in out], pa.string()),
                     pa.array([o[1] for o in out], pa.float64()), pa.array(spans, spans_type)],
                    [*part.schema.names, "_lang_pred", "_lang_score", "_lang_spans"],
                )

    return docs.mapInArrow(predict, schema)


def language_report(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, n_spans. A null ``doc_id`` is not held out."""
    model = train(docs, sample_per_language)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return identify(texts, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"),
        F.col("_lang_score").alias("score"), F.size("_lang_spans").alias("n_spans"),
    )


def keep_identified(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` that have a language: null texts and documents without any letter go.

    Where no row can teach a language, every document with a letter stays.
    """
    model = train(docs, sample_per_language)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    return identify(docs, model).where(F.col("_lang_pred") != UNKNOWN).select(*docs.columns)
