"""Language identification by mixtures: which languages, and how much of each.

Training counts character trigrams per language over every labelled document,
hashed into ``BUCKETS`` counters; the sums meet in Spark, and the model (bounded
by BUCKETS times the number of languages) is broadcast. A trigram is a letter
with its two neighbours, where anything but a letter is a word boundary.

A document is a sequence of words, each drawn from one of its languages. The
likelihood of a word under a language is the product over its trigrams;
expectation-maximisation estimates the shares of the languages. Languages are
then ranked by share, and the set of the k largest is taken with the k that
maximises the likelihood less ``PENALTY`` * log(words) for every language beyond
the first, growing k as long as that rises. The prediction is the language of
the largest share in the chosen set, its score that share.

A text that is null or has no letter is ``und`` with score 0; so is every text
if there was no labelled document to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.llm.rows import fresh, quoted

BUCKETS = 1 << 17
SMOOTHING = 0.1
PENALTY = 2.0
ROUNDS, REFINE = 8, 4
UNKNOWN = "und"
#: Documents whose first language has a smaller share are rejected by ``keep_identified``.
LEAST_SHARE = 0.3
#: Characters handled at once inside a task.
BLOCK_CHARS = 1 << 20

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts taken together: bucket of each letter's trigram, index of the first
    letter of each word, and words per text."""
    lowered = [t.lower() + "\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[points]
    here = np.flatnonzero(letter)
    kept = np.where(letter, points, 0).astype(np.uint32)
    before = np.concatenate([[0], kept[:-1]]).astype(np.uint32)[here]
    after = np.concatenate([kept[1:], [0]]).astype(np.uint32)[here]
    with np.errstate(over="ignore"):
        mixed = (before * np.uint32(0x9E3779B1)) ^ (kept[here] * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    codes = ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32)
    first = np.flatnonzero(before == 0)
    ends = np.cumsum([len(t) for t in lowered])
    words = np.diff(np.concatenate([[0], np.searchsorted(here[first], ends)]))
    return codes, first, words


def blocks(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about BLOCK_CHARS characters; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            sums = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for block in blocks(own):
                sums += np.bincount(trigrams(own[block])[0], minlength=BUCKETS)
    for lang, sums in total.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(sums[at])], ["lang", "bucket", "n"]
        )


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names, and log probabilities (BUCKETS x languages), from all rows
    whose text and language are not null."""
    rows = labelled.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text")).dropna()
    counts = (
        rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    names = sorted(counts["lang"].unique())
    table = np.full((BUCKETS, len(names)), SMOOTHING)
    table[counts["bucket"].to_numpy(int), np.searchsorted(np.array(names, object), counts["lang"].to_numpy(object))] += counts["n"].to_numpy(float)
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def mixture(likelihood: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen languages (mask) and their shares, for texts of ``words`` words each (all
    above 0). ``likelihood``: words x languages, each row scaled to a maximum of 1."""
    starts = np.concatenate([[0], np.cumsum(words)[:-1]])
    many = likelihood.shape[1]

    def step(p: np.ndarray, share: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = p * np.repeat(share, n, axis=0)
        total = weight.sum(axis=1)
        weight /= total[:, None]
        return _by_text(weight, s) / n[:, None], _by_text(np.log(total, dtype=np.float64), s)

    share = np.full((len(words), many), 1 / many, np.float32)
    for _ in range(ROUNDS if many > 1 else 0):
        share = step(likelihood, share, words, starts)[0]
    order = np.argsort(-share, axis=1, kind="stable")
    best_mask = np.zeros((len(words), many), bool)
    np.put_along_axis(best_mask, order[:, :1], True, axis=1)
    best_share = best_mask.astype(np.float32)
    first = np.take_along_axis(likelihood, np.repeat(order[:, :1], words, axis=0), axis=1)[:, 0]
    with np.errstate(divide="ignore"):
        best = _by_text(np.log(first, dtype=np.float64), starts)
    open_ = np.arange(len(words))
    for k in range(2, many + 1):
        if not len(open_):
            break
        n = words[open_]
        s = np.concatenate([[0], np.cumsum(n)[:-1]])
        picked = np.repeat(np.isin(np.arange(len(words)), open_), words)
        cols = order[open_, :k]
        p = np.take_along_axis(likelihood[picked], np.repeat(cols, n, axis=0), axis=1) + np.float32(1e-30)
        now = np.take_along_axis(share[open_], cols, axis=1) + np.float32(1e-6)
        now /= now.sum(axis=1, keepdims=True)
        for _ in range(REFINE):
            now, score = step(p, now, n, s)
        score = step(p, now, n, s)[1] - PENALTY * (k - 1) * np.log(n)
        better = score > best[open_]
        open_, cols, now = open_[better], cols[better], now[better]
        best[open_] = score[better]
        best_mask[open_] = False
        best_share[open_] = 0
        best_mask[open_[:, None], cols] = True
        best_share[open_[:, None], cols] = now
    return best_mask, best_share


def shares(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Texts x languages: the share of each language, 0 where not chosen; a row of
    zeros for a text without letters."""
    codes, first, words = trigrams(texts)
    out = np.zeros((len(texts), table.shape[1]), np.float32)
    if len(codes):
        logs = np.add.reduceat(table[codes], first, axis=0)
        logs -= logs.max(axis=1, keepdims=True)
        some = words > 0
        out[some] = mixture(np.exp(np.maximum(logs, -80)), words[some])[1]
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> tuple[DataFrame, str, str]:
    """The documents with two more columns; their names follow (``lang_pred``,
    ``score``, unless the table has such columns)."""
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        plain = ["" if t is None else t for t in texts]
        if names:
            found = [shares(plain[b], shared.value) for b in blocks(plain)]
            found = np.concatenate(found) if found else np.zeros((0, len(names)))
            top = found.argmax(axis=1)
            score = found[np.arange(len(plain)), top].astype(float)
            pred = [names[i] if s > 0 else UNKNOWN for i, s in zip(top, score)]
        else:
            pred, score = [UNKNOWN] * len(plain), np.zeros(len(plain))
        return pd.DataFrame({"lang_pred": pred, "score": np.clip(score, 0, 1)})

    guessed, pred, score = (fresh(docs, n) for n in ("guessed", "lang_pred", "score"))
    return (
        docs.withColumn(guessed, guess(F.col(quoted(text))))
        .select(*map(quoted, docs.columns), F.col(f"{guessed}.lang_pred").alias(pred), F.col(f"{guessed}.score").alias(score)),
        pred,
        score,
    )


def held_out(doc_id: Column) -> Column:
    """A third of the documents, never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                    least_share: float = LEAST_SHARE) -> DataFrame:
    """The documents with one leading language, with their columns.

    Rejected are texts without a letter (null included) and mixtures whose first
    language has less than ``least_share`` of the words: a document with a passage
    or two in other languages stays. Without any labelled document every text
    that has a letter is kept. An empty table gives an empty table.
    """
    model = train(docs.filter(~held_out(F.col(quoted(doc_id)))), text, lang)
    if not model[0]:
        return docs.filter(F.coalesce(F.col(quoted(text)), F.lit("")).rlike(r"\p{L}"))
    told, pred, score = identify(docs, model, text)
    return told.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= least_share)).select(*map(quoted, docs.columns))
