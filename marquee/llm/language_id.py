"""Operator 7: language proportions of each document by mixture inference.

Training counts hashed letter n-grams of each language over all labelled
documents.  A document is a mixture of languages: expectation-maximisation
over its n-grams finds the proportions, and the number of languages is the
one with the least penalised likelihood.  The first of them is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .util import materialize, small_batches

BUCKETS = 1 << 15  # hashed n-grams
GRAM = 3  # bytes, with word ends as one space
ROUNDS = 12  # EM rounds
PENALTY = 3.0  # nats for each language and each doubling of the n-grams
MODEL_BYTES = 256 << 20  # a model that is larger (2048 labels) is refused before anything is collected
CHUNK_BYTES = 1 << 19  # text in one inference, less by as much as there are more than 4 languages
UNKNOWN = "und"
SHRINK = 100  # n-grams as expected that are added to a text before its fit is judged
SPREADS, LEAST_GAP = 10, 1.0  # how far below the labelled rows a text's fit is that of no language


@dataclass
class LanguageModel:
    """Log-likelihood of each n-gram bucket in each language."""

    langs: list[str]
    log_p: np.ndarray  # buckets x languages, float32


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _letters() -> np.ndarray:
    """Folded byte, or 0 for what is no letter: ASCII letters and all non-ASCII bytes stay."""
    t = K.fold_table()
    t[:0x61] = 0
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x7B:0x80] = 0
    return t


def grams(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram with a letter in its middle, in text order."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z
    x = table[data].astype(np.uint32)
    left, right = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=np.uint32)
    left[1:], right[:-1] = x[:-1], x[1:]
    inner = offsets[:-1][(offsets[:-1] < n)]
    left[inner] = 0
    ends = offsets[1:][offsets[1:] > 0] - 1
    right[ends] = 0
    at = np.flatnonzero(x)
    h = (left[at] << np.uint32(16)) | (x[at] << np.uint32(8)) | right[at]
    h = (h * np.uint32(0x9E3779B1)) ^ (h >> np.uint32(7)) * np.uint32(0x85EBCA6B)
    owner = np.searchsorted(offsets, at, side="right") - 1
    return owner, (h >> np.uint32(17)).astype(np.int64)


def counted_grams(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, times) of the distinct n-grams of each text, in text order.

    A text longer than CHUNK_BYTES is counted piece by piece."""
    if len(offsets) == 2 and len(data) > CHUNK_BYTES:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for a in range(0, len(data), CHUNK_BYTES):
            lo, hi = max(0, a - 1), min(len(data), a + CHUNK_BYTES + 1)
            inner = table[data[lo:hi]]
            bucket = grams(data[lo:hi], np.array([0, hi - lo]), table)[1]
            # the neighbours of a piece only give context: their own n-grams are counted in theirs
            skip_first = int(lo < a and inner[0] != 0)
            skip_last = int(hi > a + CHUNK_BYTES and inner[-1] != 0)
            total += np.bincount(bucket[skip_first: len(bucket) - skip_last], minlength=BUCKETS)
        bucket = np.flatnonzero(total)
        return np.zeros(len(bucket), dtype=np.int64), bucket, total[bucket]
    owner, bucket = grams(data, offsets, table)
    key, n = np.unique(owner * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, n


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, total = _letters(), {}
    for b in batches:
        langs = b.column(1).to_pylist()
        data, off = K.utf8_column(b.column(0))
        for i, j in K.chunks(off, CHUNK_BYTES):
            owner, bucket, n = counted_grams(data[off[i]: off[j]], off[i: j + 1] - off[i], table)
            for x in set(langs[i:j]):
                mine = np.array([y == x for y in langs[i:j]])[owner]
                if x not in total:
                    total[x] = np.zeros(BUCKETS, dtype=np.int64)
                np.add.at(total[x], bucket[mine], n[mine])
        if len(total) > 64:  # many labels: what a task holds stays small
            yield from _flush(total)
    yield from _flush(total)


def _flush(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for x, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "bucket", "n"])
    total.clear()


def train(labelled: DataFrame) -> LanguageModel:
    """Count n-grams over all rows with text and lang.

    The labels are counted first: a model of more than MODEL_BYTES is an error
    that says how many there are.  Then BUCKETS counts of each, at most, are
    read a partition at a time into the model's array.

    Null text or lang: not used.  Repeated rows count each.  Very long texts:
    counted whole, in pieces.  No usable rows: a model without languages.
    Other columns are not read."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    most = MODEL_BYTES // (4 * BUCKETS)
    labels = labelled.select(F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL").distinct().limit(most + 1).collect()
    if len(labels) > most:
        raise ValueError(f"more than {most} languages; a model of {MODEL_BYTES >> 20} MB holds no more")
    langs = sorted(r.lang for r in labels)
    code = {x: k for k, x in enumerate(langs)}
    table = np.full((BUCKETS, max(1, len(langs))), 0.1, dtype=np.float32 if len(langs) > 64 else np.float64)
    total = rows.mapInArrow(_count_rows, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    seen = set()
    with small_batches(labelled.sparkSession):
        for r in total.toLocalIterator():
            table[r.bucket, code[r.lang]] += r.n
            seen.add(r.lang)
    known = [k for k, x in enumerate(langs) if x in seen]  # a label whose texts have no letter teaches nothing
    table = table[:, known] if known else table[:, :1]
    return LanguageModel([langs[k] for k in known], np.log(table / table.sum(axis=0)).astype(np.float32))


def _em(p: np.ndarray, like: np.ndarray, n: np.ndarray, first: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts x languages) after ROUNDS rounds from ``p``, and the
    log-likelihood; languages that start at 0 stay there."""
    total = np.add.reduceat(n, first)
    for _ in range(ROUNDS):
        r = p[row] * like
        r *= (n / np.maximum(r.sum(axis=1), 1e-300))[:, None]
        p = np.add.reduceat(r, first, axis=0) / total[:, None]
    r = np.maximum((p[row] * like).sum(axis=1), 1e-300)
    return p, np.add.reduceat(n * np.log(r), first)


def infer(own: np.ndarray, bucket: np.ndarray, times: np.ndarray, texts: int, log_p: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) from counted n-grams: the set of languages with
    the least penalised likelihood among the likeliest 1, 2, ... of each text; 0 outside."""
    langs = log_p.shape[1]
    out = np.zeros((texts, langs))
    if not len(own):
        return out
    n = times.astype(float)
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    who = own[first]
    row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(own)]))
    like = log_p[bucket].astype(float)
    like -= like.max(axis=1, keepdims=True)
    np.exp(like, out=like)
    full, most = _em(np.full((len(first), langs), 1.0 / langs), like, n, first, row)
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = PENALTY * np.log2(2 + np.add.reduceat(n, first))
    best_p = np.zeros((len(first), langs))
    np.put_along_axis(best_p, order[:, :1], 1.0, axis=1)
    cost = -np.add.reduceat(n * np.log(np.maximum((best_p[row] * like).sum(axis=1), 1e-300)), first)
    for k in range(2, langs + 1):
        # no set of languages fits better than all together: k of them can only win if that gain pays their penalty
        open_ = np.flatnonzero(cost + most > penalty * (k - 1))
        if not len(open_):
            break
        part = np.isin(row, open_)
        sub_row = np.searchsorted(open_, row[part])
        sub_first = np.flatnonzero(np.r_[True, sub_row[1:] != sub_row[:-1]])
        start = np.zeros((len(open_), langs))
        np.put_along_axis(start, order[open_, :k], np.maximum(np.take_along_axis(full[open_], order[open_, :k], axis=1), 1e-6), axis=1)
        p, fit = _em(start / start.sum(axis=1, keepdims=True), like[part], n[part], sub_first, sub_row)
        now = -fit + penalty[open_] * (k - 1)
        wins = now < cost[open_]
        best_p[open_[wins]], cost[open_[wins]] = p[wins], now[wins]
    out[who] = best_p
    return out


def usual_fit(log_p: np.ndarray) -> np.ndarray:
    """Mean log-likelihood of an n-gram that each language draws."""
    logs = log_p.astype(float)
    return (np.exp(logs) * logs).sum(axis=0)


def fitness(own: np.ndarray, bucket: np.ndarray, times: np.ndarray, p: np.ndarray, log_p: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How much better a text's n-grams fit its proportions than texts drawn
    from the model do, in nats an n-gram; SHRINK n-grams that fit as expected
    are added, so a short text is near 0.  0 for texts without n-grams."""
    out = np.zeros(len(p))
    if not len(own):
        return out
    want = (p * (usual + np.log(np.maximum(p, 1e-300)))).sum(axis=1)  # a text in parts: each part under its own share
    logs = log_p[bucket].astype(float)
    top = logs.max(axis=1)
    got = np.log(np.maximum((p[own] * np.exp(logs - top[:, None])).sum(axis=1), 1e-300)) + top
    total = np.bincount(own, weights=times, minlength=len(p))
    gain = np.bincount(own, weights=times * (got - want[own]), minlength=len(p))
    return gain / (total + SHRINK)


ADDED = ["__op_lang", "__op_score", "__op_mix", "__op_fit"]


def _infer_rows(langs: list[str], log_p, at: int, fit: bool):
    """Adds the four private columns to rows with a letter flag and the text in column ``at``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, chunk = _letters(), max(1 << 14, 4 * CHUNK_BYTES // max(4, len(langs)))
        usual = usual_fit(log_p.value) if fit else None
        for b in batches:
            data, off = K.utf8_column(b.column(at))
            letter = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            pred, score, mix, fits = [], [], [], []
            for i, j in K.chunks(off, chunk):
                own, bucket, times = counted_grams(data[off[i]: off[j]], off[i: j + 1] - off[i], table)
                p = infer(own, bucket, times, j - i, log_p.value) if langs else np.zeros((j - i, 0))
                fits.append(fitness(own, bucket, times, p, log_p.value, usual) if fit and langs else np.zeros(j - i))
                for d in range(j - i):
                    if not langs or not letter[i + d] or not p[d].any():
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        mix.append([])
                        continue
                    k = int(np.argmax(p[d]))
                    pred.append(langs[k])
                    score.append(float(min(1.0, p[d, k])))
                    mix.append([{"lang": langs[x], "share": float(p[d, x])} for x in np.argsort(-p[d], kind="stable") if p[d, x] > 0.005])
            mixes = pa.array(mix, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
            cols = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), mixes, pa.array(np.concatenate([np.zeros(0), *fits]), pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *cols], names=[*b.schema.names[1:], *ADDED])

    return rows


def _inferred(docs: DataFrame, model: LanguageModel, fit: bool = False) -> DataFrame:
    """``docs`` (whose column ``text`` is read once) with the private columns
    __op_lang, __op_score, __op_mix and, with ``fit``, __op_fit (see ``fitness``)."""
    text = F.col("text").cast("string")
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("__op_letter")
    is_string = dict(docs.dtypes)["text"] == "string"
    rows = docs.select(letter, "*") if is_string else docs.select(letter, "*", text.alias("__op_text"))
    at = rows.columns.index("text" if is_string else "__op_text")
    schema = rows.drop("__op_letter").withColumns({"__op_lang": F.lit(""), "__op_score": F.lit(0.0), "__op_mix": F.lit(None).cast("array<struct<lang:string,share:double>>"), "__op_fit": F.lit(0.0)}).schema
    sent = docs.sparkSession.sparkContext.broadcast(model.log_p)  # MODEL_BYTES at most
    return rows.mapInArrow(_infer_rows(model.langs, sent, at, fit), schema)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred, score (the share of that
    language) and mixture (all languages of the chosen set with their shares).

    Only the text is used.  Null or empty texts, texts without a letter and a
    model without languages: ``und`` with score 0.  Equal shares: the first
    language by name.  Very long texts: used whole, in pieces.  No shuffle;
    repeated rows get equal results; an empty table gives no rows.  Kept
    columns named like an added one, in any case, are replaced."""
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", "mixture")]
    rows = _inferred(docs.select(*dict.fromkeys([*keep, "text"])), model)
    return rows.select(*keep, F.col("__op_lang").alias("lang_pred"), F.col("__op_score").alias("score"), F.col("__op_mix").alias("mixture"))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, mixture): learned from the rows with
    a lang whose crc32(doc_id as text) mod 4 is not 2, predicted for all.

    A null doc_id is no held-out row and no training row either.  Texts and
    edges: as in ``predict`` and ``train``.  Extra columns are not read."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    return predict(rows, model, ["doc_id", "held_out"])


def least_fit(found: DataFrame) -> float:
    """The fit below which a text is in no learned language: as far under the
    median of all rows with a lang as SPREADS times their lower decile, or
    LEAST_GAP nats if that is more.  Both bear some rows with wrong labels."""
    labelled = found.where((F.col("lang").isNotNull()) & (F.col("__op_lang") != UNKNOWN))
    q = labelled.agg(F.percentile_approx("__op_fit", [0.5, 0.1], 10_000).alias("q")).first().q
    return q[0] - max(LEAST_GAP, SPREADS * (q[0] - q[1])) if q else -np.inf


def reject_unknown(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without those whose language is unknown, whose main language
    has less than ``least`` of the text, or that fit none of the learned
    languages: their n-grams are far less likely than those of the labelled rows.

    One inference, written once: the bound of the fit and the filter both read
    it.  Null or empty texts and texts without a letter go (their language is
    unknown).  All columns stay as they are, whatever their names; repeated
    rows stay or go together.  A null lang or doc_id is no training row.  No
    labels: no language is known, so all rows go.  Empty table: no rows."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = materialize(_inferred(docs, model, fit=True), "languages")
    known = (F.col("__op_lang") != UNKNOWN) & (F.col("__op_score") >= least) & (F.col("__op_fit") >= F.lit(float(least_fit(found))))
    return found.where(known).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs.select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")
