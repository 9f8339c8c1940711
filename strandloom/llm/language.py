"""Document and paragraph languages (problem 10): word-first backoff.

A word that the model knows scores the log frequency it has in each language;
an unseen word falls back to its character 5-grams, and if none of them is
known to 4-grams, and so on to single characters. A paragraph's language has
the highest sum; its confidence is the probability of that sum against the
others, tempered by the number of words that were scored.

The model is fitted here, on a bounded sample of labelled documents
(``FIT_DOCUMENTS`` a language, those of smallest hash). Languages are counted,
which fixes a threshold of the hash for each; only the hashes below it, which
are little more than the sample, are put in order, and the texts are read where
they lie, so no text is shuffled to be drawn. Labels may be wrong
and texts mixed, so it is fitted twice: the first model, from the documents'
labels, gives every paragraph of the sample its language, and the second is
fitted on these. ``MODEL_WORDS`` and ``MODEL_GRAMS`` bound the model's size.
Everything else covers every paragraph of every document, whole.

Letters are compared without case and accents. Quoted passages are left out
unless nothing else is there.

Defined results: null text has no paragraphs; a paragraph without a letter has
a null language and confidence 0; ties go to the language that is first in
order of its code.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textform
from strandloom.runtime import Scratch, spread

FIT_DOCUMENTS = 2_000
MODEL_WORDS = 20_000
MODEL_GRAMS = 20_000
LONGEST = 5
#: Counts that a task holds at most before it sends them.
MOST_COUNTS = 4_000_000
#: Log probability that is taken off for a gram of one character less.
SMOOTH = 0.5

# Codes of two letters, of three letters (both kinds) and English names of languages.
LANGUAGES = {
    "en": "eng english", "es": "spa spanish castilian", "pt": "por portuguese", "fr": "fra fre french", "de": "deu ger german", "nl": "nld dut dutch flemish",
    "it": "ita italian", "ca": "cat catalan", "gl": "glg galician", "ro": "ron rum romanian", "pl": "pol polish", "cs": "ces cze czech", "sk": "slk slo slovak", "sv": "swe swedish", "da": "dan danish", "no": "nor norwegian", "fi": "fin finnish",
    "et": "est estonian", "lv": "lav latvian", "lt": "lit lithuanian", "hu": "hun hungarian", "el": "ell gre greek", "tr": "tur turkish", "ru": "rus russian", "uk": "ukr ukrainian", "bg": "bul bulgarian", "hr": "hrv croatian", "sr": "srp serbian",
    "sl": "slv slovenian", "ar": "ara arabic", "he": "heb hebrew", "fa": "fas per persian", "hi": "hin hindi", "bn": "ben bengali", "zh": "zho chi chinese", "ja": "jpn japanese", "ko": "kor korean", "vi": "vie vietnamese", "th": "tha thai", "id": "ind indonesian",
    "ms": "msa may malay", "la": "lat latin", "eu": "eus baq basque", "cy": "cym wel welsh", "ga": "gle irish", "af": "afr afrikaans", "is": "isl ice icelandic", "sq": "sqi alb albanian",
}


def named_language(label: Column | str) -> Column:
    """The two-letter code that a label names, by code, region code or English name; null if it names none."""
    label = F.col(label) if isinstance(label, str) else label
    names = [x for code, others in LANGUAGES.items() for x in (code, *others.split()) for x in (x, code)]
    first = F.lower(F.regexp_extract(label, r"^\s*([A-Za-z]+)\s*(?:[-_][A-Za-z0-9_-]*)?\s*$", 1))
    return F.try_element_at(F.create_map(*map(F.lit, names)), first)


QUOTED = r'"[^"\n]*"|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]'


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(lo, hi - lo) for b in batches for lo, hi in textform.slices(b.column(b.num_columns - 1)))


def _paragraphs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of every paragraph, and the paragraphs."""
    column = batch.column(batch.num_columns - 1)
    parts = pc.split_pattern(column, "\n\n")
    rows = pc.list_parent_indices(parts).to_numpy()
    number = np.arange(rows.size) - np.searchsorted(rows, rows)
    return rows, number, pc.list_flatten(parts)


_fold = np.arange(textform.TOP, dtype=np.uint32)
_folded = np.zeros(textform.TOP, np.bool_)


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The one form without accents and marks, in lower case."""
    cps, offsets = textform.canonical(column)
    fresh = cps[~_folded[cps]]
    for cp in np.unique(fresh).tolist():
        base = unicodedata.normalize("NFD", chr(cp).lower())[:1]
        _fold[cp], _folded[cp] = ord(base), True
    cps = _fold[cps]
    textform.tables().learn(cps)
    return cps, offsets


def _grams(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words, their ends marked, and the word of each; shorter words give none."""
    count = np.maximum(ends - starts - n + 1, 0)
    word = np.repeat(np.arange(starts.size), count)
    at = np.repeat(starts, count) + np.arange(word.size) - np.repeat(np.cumsum(count) - count, count)
    out = np.full(word.size, n, np.uint64)
    for j in range(n):
        out = textform.mix(out * textform.BASE + cps[at + j].astype(np.uint64))
    out = out ^ ((at == starts[word]).astype(np.uint64) << np.uint64(61)) ^ ((at + n == ends[word]).astype(np.uint64) << np.uint64(62))
    return out, word


class Model:
    """Sorted hashes and a row of log frequencies for words (index 0) and n-grams (index n)."""

    def __init__(self, languages: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray]], totals: np.ndarray):
        self.languages = languages
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(LONGEST + 1):
            keys, table = counts.get(n, (np.zeros(0, np.uint64), np.zeros((0, len(languages)))))
            order = np.argsort(keys)
            score = np.log((table[order] + SMOOTH) / (totals[n] + SMOOTH * max(len(keys), 1)))
            self.tables.append((keys[order], (score - score.mean(axis=1, keepdims=True) if len(keys) else score).astype(np.float32)))

    def look(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, table = self.tables[n]
        if not keys.size:
            return np.zeros(hashes.size, np.bool_), np.zeros((hashes.size, len(self.languages)), np.float32)
        at = np.minimum(np.searchsorted(keys, hashes), keys.size - 1)
        known = keys[at] == hashes
        return known, np.where(known[:, None], table[at], np.float32(0))

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sum of scores of each text by language, and the number of words scored."""
        cps, offsets = _plain(column)
        hashes, starts, ends, rows = textform.words(cps, offsets)
        n = len(column)
        known, got = self.look(0, hashes)
        unseen = np.flatnonzero(~known & ~_digits(cps, starts, ends))
        for size in range(LONGEST, 0, -1):
            if not unseen.size:
                break
            gram, word = _grams(cps, starts[unseen], ends[unseen], size)
            seen, value = self.look(size, gram)
            times = np.bincount(word[seen], minlength=unseen.size)
            for k in range(got.shape[1]):
                total = np.bincount(word[seen], value[seen, k], minlength=unseen.size)
                got[unseen, k] = np.where(times > 0, total / np.maximum(times, 1), 0)
            known[unseen[times > 0]] = True
            unseen = unseen[times == 0]
        row = np.repeat(np.arange(n), np.diff(rows))
        sums = np.stack([np.bincount(row, got[:, k], minlength=n) for k in range(got.shape[1])], axis=1)
        return sums, np.bincount(row[known], minlength=n)

    def judge(self, sums: np.ndarray, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its confidence; confidence 0 where nothing was scored."""
        tempered = sums / np.sqrt(np.maximum(scored, 1))[:, None]
        p = np.exp(tempered - tempered.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, np.where(scored > 0, p[np.arange(len(best)), best], 0.0)


def _digits(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words without a letter."""
    digit = np.zeros(cps.size + 1, np.int64)
    np.cumsum((cps >= 48) & (cps <= 57), out=digit[1:])
    return digit[ends] - digit[starts] == ends - starts


def _scores(model: Model, paragraphs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Scores without quoted passages; with them where nothing else is there."""
    sums, scored = model.score(pc.replace_substring_regex(paragraphs, QUOTED, " "))
    bare = np.flatnonzero(scored == 0)
    if bare.size:
        sums[bare], scored[bare] = model.score(paragraphs.take(pa.array(bare)))
    return sums, scored


def _features(languages: list[str], held=None):
    """Counts of words and grams by language: ``kind, hash, lang, n``. The language is the label's, or the one that a first model gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts are added up in the task before they are sent
        held_back: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, parts in held_back.items():
                key, of, count = _summed(*(np.concatenate(p) for p in zip(*parts)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(key.size, kind, np.int32)), pa.array(key.view(np.int64)), pa.array(of.astype(np.int32)), pa.array(count)], ["kind", "hash", "lang", "n"])
            held_back.clear()

        for batch in _small(batches):
            rows, _, paragraphs = _paragraphs(batch)
            if not rows.size:
                continue
            if held is None:
                lang = np.array([languages.index(x) for x in batch.column(0).to_pylist()])[rows]
                keep = np.arange(rows.size)
            else:
                sums, scored = _scores(held.value, paragraphs)
                lang, sure = held.value.judge(sums, scored)
                keep = np.flatnonzero(sure >= 0.8)
            lang = lang[keep]
            plain = pc.replace_substring_regex(paragraphs.take(pa.array(keep)), QUOTED, " ")
            cps, offsets = _plain(plain)
            hashes, starts, ends, at = textform.words(cps, offsets)
            lang = np.repeat(lang, np.diff(at))
            letters = ~_digits(cps, starts, ends)
            hashes, starts, ends, lang = hashes[letters], starts[letters], ends[letters], lang[letters]
            for kind in range(LONGEST + 1):
                key, word = (hashes, np.arange(hashes.size)) if kind == 0 else _grams(cps, starts, ends, kind)
                if key.size:
                    held_back.setdefault(kind, []).append(_summed(key, lang[word], np.ones(key.size, np.int64)))
            if sum(part[0].size for parts in held_back.values() for part in parts) > MOST_COUNTS:
                yield from flush()
        yield from flush()

    return run


def _summed(key: np.ndarray, lang: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (key, language), added up."""
    order = np.lexsort((lang, key))
    key, lang, n = key[order], lang[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (lang[1:] != lang[:-1]))))
    return key[new], lang[new], np.add.reduceat(n, new)


def _fit(sample: DataFrame, languages: list[str], held=None) -> Model:
    counted = sample.mapInArrow(_features(languages, held), "kind int, hash long, lang int, n long").groupBy("kind", "hash").pivot("lang", list(range(len(languages)))).agg(F.sum("n")).fillna(0)
    cols = [str(k) for k in range(len(languages))]
    size = sum(F.col(c) for c in cols)
    counted = counted.withColumn("size", size).where("size > 1")
    kept = counted.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("size"), "hash")))
    kept = kept.where(F.col("rank") <= F.when(F.col("kind") == 0, MODEL_WORDS).otherwise(MODEL_GRAMS)).toPandas()
    totals = np.ones((LONGEST + 1, len(languages)))
    counts = {}
    for kind, part in kept.groupby("kind"):
        table = part[cols].to_numpy(np.float64)
        counts[int(kind)] = (part["hash"].to_numpy(np.int64).view(np.uint64), table)
        totals[int(kind)] = np.maximum(table.sum(axis=0), 1)
    return Model(languages, counts, totals)


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = FIT_DOCUMENTS) -> Model:
    """A model from at most ``per_language`` labelled documents of each language that the labels name."""
    scratch = Scratch(documents.sparkSession, "language")
    named = documents.select(F.col(doc_id).alias("doc_id"), named_language(label).alias("lang"), F.col(text).alias("text")).where("doc_id is not null and lang is not null and text is not null")
    named = named.withColumn("order", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    # a row per language that a label can name
    labelled = documents.select(named_language(label).alias("lang")).where("lang is not null")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model(["und"], {}, np.ones((LONGEST + 1, 1)))
    # the share of hashes that holds the sample, with a margin of six deviations
    margin = per_language + 6 * per_language**0.5 + 20
    limits = [x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(2**63 - 1, int(margin / n * 2.0**63))))]
    below = scratch.save(named.where(F.col("order") <= F.element_at(F.create_map(*limits), F.col("lang"))), "below")
    top = Window.partitionBy("lang").orderBy("order", "doc_id")
    picked = below.groupBy("lang", "order", "doc_id").agg(F.lit(1)).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= per_language).select("lang", "order", "doc_id")
    # a document given again under its id is taken once; the picked ids are at most per_language a language
    sample = below.join(F.broadcast(picked), ["lang", "order", "doc_id"], "left_semi")
    unique = below.groupBy("lang", "doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    sample = (sample if unique else sample.dropDuplicates(["lang", "doc_id"])).select("lang", "text")
    sample = scratch.save(sample, "sample")
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not languages:
        return Model(["und"], {}, np.ones((LONGEST + 1, 1)))
    sample = spread(sample)
    first = _fit(sample, languages)
    return _fit(sample, languages, documents.sparkSession.sparkContext.broadcast(first))


def _label_paragraphs(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = np.array(model.languages, object)
        for batch in _small(batches):
            rows, number, paragraphs = _paragraphs(batch)
            if not rows.size:
                continue
            sums, scored = _scores(model, paragraphs)
            best, sure = model.judge(sums, scored)
            n = batch.num_rows
            whole = np.stack([np.bincount(rows, sums[:, k], minlength=n) for k in range(sums.shape[1])], axis=1)
            many = np.bincount(rows, scored, minlength=n)
            doc_best, doc_sure = model.judge(whole, many)
            lang = np.where(scored > 0, names[best], None)
            doc = np.where(many > 0, names[doc_best], None)
            arrays = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.array(lang, pa.string()), pa.array(sure), pa.array(doc[rows], pa.string()), pa.array(doc_sure[rows])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "named", "para_no", "lang", "confidence", "doc_lang", "doc_confidence"])

    return run


def paragraphs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", model: Model | None = None) -> DataFrame:
    """A row per paragraph: ``doc_id, named, para_no, lang, confidence, doc_lang, doc_confidence``; ``named`` is the language that the label names."""
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(model or fit(documents, doc_id, text, label))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), named_language(label).alias("named"), F.col(text).alias("text")).where("text is not null")
    return spread(rows).mapInArrow(_label_paragraphs(held), "doc_id long, named string, para_no int, lang string, confidence double, doc_lang string, doc_confidence double")


def mislabelled(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, para_no, lang`` of every paragraph whose language is not the one that its document names."""
    found = paragraphs(documents, **options)
    return found.where("lang is not null and not lang <=> named").select("doc_id", "para_no", "lang")
