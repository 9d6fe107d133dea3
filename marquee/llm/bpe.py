"""Operator 12: byte-pair encoding and decoding with a lexicon transducer.

The corpus' frequent words are encoded once and compiled into a minimal
acyclic transducer: a byte automaton with shared suffixes whose arcs put out
token ids.  It is one file that Spark ships to the executors and that their
Python workers map into memory.  A chunk's words walk it all at once, a byte a
step; words that it lacks are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import app_scratch_dir, materialize, table

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
LEXICON = 1 << 16  # words in the transducer at most; all others are merged
LONGEST = 64  # bytes of a word in the transducer
MEMO = 200_000  # merged words, or counted ones, that a task keeps; it then starts anew
OCTAVE = 16  # word counts are told apart by so many steps for each doubling
PIECE = 1 << 20  # characters of a long text that are cut at a time
SHORT = 32  # bytes of a word up to which looking at all pairs beats a queue
SPACE, LETTER, DIGIT, OTHER, NEWER = range(5)
SPECIAL = 0xD800  # special tokens stand for themselves as lone surrogates, which no text has
APOSTROPHE = ord("'")
#: Endings that follow an apostrophe and are words with it.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


# ---- vocabulary -------------------------------------------------------------

@dataclass
class Vocabulary:
    """What a vocabulary file says: token bytes, merges and special tokens."""

    tokens: list[bytes]  # the string of each id, in UTF-8
    inner: list[int]  # id of each byte inside a word
    last: list[int]  # and at its end
    ranks: dict[tuple[int, int], int]  # rank of each pair that merges
    merged: list[int]  # id that the pair of each rank becomes
    special: dict[str, int]
    classes: np.ndarray = field(repr=False)  # of all code points
    source: str = field(repr=False)  # the file's text


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: visible Latin-1
    characters are themselves, the others follow from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    fresh = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(fresh)) for b in range(256)]


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Read on the driver and sent to the tasks (a vocabulary file is a few MB)."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    model, added = spec["model"], spec["added_tokens"]
    end = model["end_of_word_suffix"]
    if model["type"] != "BPE" or not end or spec["decoder"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("not a vocabulary of byte pairs with word ends and plain special tokens")
    ids: dict[str, int] = model["vocab"]
    special = {t["content"]: t["id"] for t in added}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for t, i in [*ids.items(), *special.items()]:
        tokens[i] = t.encode()
    letters = byte_letters()
    ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(model["merges"])}
    merged = [ids[a + b] for a, b in model["merges"]]
    return Vocabulary(tokens, [ids[x] for x in letters], [ids[x + end] for x in letters], ranks, merged, special, character_classes(), source)


def merge_word(word: bytes, v: Vocabulary) -> tuple[int, ...]:
    """Ids of a word: the pair of least rank is merged, leftmost first, until none is left."""
    if not word:
        return ()
    ids = [v.inner[b] for b in word[:-1]]
    ids.append(v.last[word[-1]])
    if len(ids) > SHORT:
        return _merge_long(ids, v)
    rank, none = v.ranks.get, len(v.merged)
    ranks = [rank(p, none) for p in zip(ids, ids[1:])]
    while ranks:
        least = min(ranks)
        if least == none:
            break
        i = ranks.index(least)
        ids[i: i + 2] = [v.merged[least]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = rank((ids[i], ids[i + 1]), none)
        if i:
            ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
    return tuple(ids)


def _merge_long(ids: list[int], v: Vocabulary) -> tuple[int, ...]:
    """The same with a queue of pairs: n log n steps for a word of any length."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := v.ranks.get((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(queue)
    while queue:
        r, i, left, right = heapq.heappop(queue)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue  # one of the two has gone into another pair
        ids[i], ids[j] = v.merged[r], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, z in ((before[i], i), (i, after[i])):
            if a >= 0 and z < n and (r := v.ranks.get((ids[a], ids[z]))) is not None:
                heapq.heappush(queue, (r, a, ids[a], ids[z]))
    return tuple(x for x in ids if x >= 0)


# ---- words ------------------------------------------------------------------

def character_classes() -> np.ndarray:
    """Class of each code point, from its Unicode category; NEWER are those
    that Python's Unicode tables do not know."""
    kinds = {"L": LETTER, "N": DIGIT, "Z": SPACE}
    category = [unicodedata.category(chr(c)) for c in range(0x110000)]
    out = np.array([NEWER if k == "Cn" else kinds.get(k[0], OTHER) for k in category], dtype=np.uint8)
    out[[*range(0x09, 0x0E), 0x85]] = SPACE
    out[SPECIAL: 0xE000] = DIGIT  # each a word by itself
    return out


def code_points(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), dtype=np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Words:
    """Cuts texts into words: letters, single digits, endings after an
    apostrophe, runs of other signs; white space only separates."""

    def __init__(self, v: Vocabulary) -> None:
        self.known, self.classes = v.classes, v.classes.copy()
        self.source, self.library = v.source, None
        self.special = {s: chr(SPECIAL + k) for k, s in enumerate(v.special)}
        self.cut = re.compile("|".join(map(re.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None

    def newer(self, text: str) -> list[int]:
        """Code points of ``text`` that Python's Unicode tables do not know."""
        c = code_points(text)
        return np.unique(c[self.known[c] == NEWER]).tolist()

    def normal(self, text: str, plain: bool) -> str:
        """NFC in lower case; letters are lowered one by one, so a last sigma is like any.
        Not ``plain``: there may be characters of a newer Unicode."""
        if text.isascii():
            return text.lower()
        if not plain and (fresh := self.newer(text)):
            return self._newer(text, fresh)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _newer(self, text: str, fresh: list[int]) -> str:
        """The tokenizers library knows the newer characters' normal form and class."""
        from tokenizers import Tokenizer

        self.library = self.library or Tokenizer.from_str(self.source)
        cut = self.library.pre_tokenizer.pre_tokenize_str
        out = self.library.normalizer.normalize_str(text)
        for c in {*fresh, *self.newer(out)}:
            self.classes[c] = LETTER if len(cut("a" + chr(c))) == 1 else OTHER if len(cut("!" + chr(c))) == 1 else DIGIT
        return out

    def prepared(self, text: str, plain: bool) -> str:
        """The normal form, in which special tokens are single characters."""
        if self.cut is None or not (found := list(self.cut.finditer(text))):
            return self.normal(text, plain)
        out, at = [], 0
        for m in found:
            out += [self.normal(text[at: m.start()], plain), self.special[m.group()]]
            at = m.end()
        return "".join([*out, self.normal(text[at:], plain)])

    def pieces(self, texts: list[str | None]) -> Iterator[list[str | None]]:
        """``texts``, or pieces of a single long one: nothing joins across white space."""
        text = texts[0] if len(texts) == 1 else None
        if not text or len(text) <= PIECE or any(not s.split() or len(s.split()) > 1 for s in self.special):
            yield texts
            return
        at = 0
        while at < len(text):
            ends = [e for x in " \n" if (e := text.find(x, at + PIECE)) >= 0]
            end = min(ends, default=len(text))
            yield [text[at:end]]
            at = end

    def split(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, word starts, word ends, first word of each text and of a last one)."""
        plain = not self.newer("\n".join(t for t in texts if t and not t.isascii()))
        ready = [self.prepared(t, plain) if t else "" for t in texts]
        whole = "\n".join(ready)
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        place = np.cumsum([0, *(len(t) + 1 for t in ready)])
        c = code_points(whole)
        n = len(c)
        if n == 0:
            none = np.zeros(0, dtype=np.int64)
            return data, none, none, np.zeros(len(place), dtype=np.int64)
        kind = self.classes[c]
        start = kind != SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        self._endings(c, kind, start)
        end = kind != SPACE
        end[:-1] &= start[1:] | (kind[1:] == SPACE)
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        first = np.searchsorted(s, place)
        if len(data) != n:
            width = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
            at = np.r_[0, np.cumsum(width)]
            s, e = at[s], at[e]
        return data, s, e, first

    @staticmethod
    def _endings(c: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """An apostrophe that begins a run of signs takes an ending with it."""
        n = len(c)
        at = np.flatnonzero((c == APOSTROPHE) & start)
        at = at[at + 1 < n]
        at = at[kind[at + 1] == LETTER]
        for ending in ENDINGS:
            here = at[at + len(ending) < n]
            for k, x in enumerate(ending, 1):
                here = here[c[here + k] == ord(x)]
            start[here + 1] = False
            rest = here + len(ending) + 1
            start[rest[rest < n]] |= kind[rest[rest < n]] == LETTER


# ---- lexicon ----------------------------------------------------------------

class _State:
    __slots__ = ("arcs", "final", "number", "output")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}  # byte -> [state, output]
        self.final, self.output, self.number = False, (), -1


class _Builder:
    """Minimal acyclic transducer from sorted words: outputs move towards the
    root as far as words share them, and equal suffix states become one."""

    def __init__(self) -> None:
        self.path = [_State()]
        self.states: list[_State] = []
        self.known: dict[tuple, _State] = {}
        self.word = b""

    def _frozen(self, state: _State) -> _State:
        key = (state.final, state.output, *((b, t.number, out) for b, (t, out) in state.arcs.items()))
        same = self.known.get(key)
        if same is None:
            state.number = len(self.states)
            self.states.append(state)
            self.known[key] = same = state
        return same

    def _shrink(self, keep: int) -> None:
        for i in range(len(self.word), keep, -1):
            self.path[i - 1].arcs[self.word[i - 1]][0] = self._frozen(self.path[i])
        del self.path[keep + 1:]

    def add(self, word: bytes, output: tuple[int, ...]) -> None:
        shared, least = 0, min(len(word), len(self.word))
        while shared < least and word[shared] == self.word[shared]:
            shared += 1
        self._shrink(shared)
        for i in range(shared):
            arc = self.path[i].arcs[word[i]]
            same = 0
            while same < min(len(arc[1]), len(output)) and arc[1][same] == output[same]:
                same += 1
            rest, arc[1], output = arc[1][same:], arc[1][:same], output[same:]
            if rest:
                child = self.path[i + 1]
                for other in child.arcs.values():
                    other[1] = rest + other[1]
                if child.final:
                    child.output = rest + child.output
        for b in word[shared:]:
            state = _State()
            self.path[-1].arcs[b] = [state, output]
            self.path.append(state)
            output = ()
        self.path[-1].final = True
        self.path[-1].output = output
        self.word = word

    def close(self) -> int:
        self._shrink(0)
        return self._frozen(self.path[0]).number


class Lexicon:
    """The transducer in arrays: sorted arcs (state, byte), their targets and
    outputs, the outputs of final states, and a pool of id sequences."""

    def __init__(self, arrays: list[np.ndarray]) -> None:
        (self.root,), self.keys, self.target, self.output, self.final, self.pool_at, self.pool = arrays

    @staticmethod
    def build(words: Iterable[tuple[bytes, tuple[int, ...]]]) -> Lexicon:
        b = _Builder()
        for word, ids in sorted(words):
            b.add(word, ids)
        root = b.close()
        pool: dict[tuple[int, ...], int] = {(): 0}
        arcs = sorted((s.number << 8 | x, t.number, pool.setdefault(out, len(pool))) for s in b.states for x, (t, out) in s.arcs.items())
        final = [pool.setdefault(s.output, len(pool)) if s.final else -1 for s in b.states]
        key, target, output = zip(*arcs, strict=True) if arcs else ((), (), ())
        sizes = np.cumsum([0, *map(len, pool)])
        return Lexicon([np.array(x, dtype=np.int64) for x in ([root], key, target, output, final, sizes, [i for p in pool for i in p])])

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.root]), self.keys, self.target, self.output, self.final, self.pool_at, self.pool]

    def to_bytes(self) -> bytes:
        parts = self.arrays()
        return b"".join(x.astype(np.int64).tobytes() for x in [np.array([len(x) for x in parts]), *parts])

    @staticmethod
    def mapped(path: str) -> Lexicon:
        """The arrays of a file; workers of one machine share its memory."""
        whole = np.memmap(path, dtype=np.int64, mode="r")
        ends = 7 + np.cumsum(whole[:7])
        return Lexicon([whole[a:b] for a, b in zip([7, *ends[:-1].tolist()], ends.tolist(), strict=True)])

    def walk(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, word, output): whether each word is in the lexicon, and the
        non-empty outputs on the way of those that are, in order."""
        found = np.zeros(len(start), dtype=bool)
        word = np.flatnonzero(end - start <= LONGEST) if len(self.keys) else np.zeros(0, dtype=np.int64)
        state = np.full(len(word), self.root)
        at, stop = start[word], end[word]
        seen, put = [], []
        while len(word):
            done = at == stop
            if done.any():
                out = self.final[state[done]]
                hit = word[done][out >= 0]
                found[hit] = True
                seen.append(hit)
                put.append(out[out >= 0])
                word, state, at, stop = (x[~done] for x in (word, state, at, stop))
                continue
            key = state << 8 | data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            word, at, stop, arc = word[ok], at[ok] + 1, stop[ok], arc[ok]
            state = self.target[arc]
            seen.append(word)
            put.append(self.output[arc])
        w, o = np.concatenate([*seen, np.zeros(0, dtype=np.int64)]), np.concatenate([*put, np.zeros(0, dtype=np.int64)])
        some = (o > 0) & found[w]
        w, o = w[some], o[some]
        order = np.argsort(w, kind="stable")  # steps were met in order
        return found, w[order], o[order]


# ---- Spark ------------------------------------------------------------------

def _count_rows(vocabulary):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, values, powers = Words(vocabulary.value), K.byte_values(), K.Powers()
        total: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            _, off = K.utf8_column(b.column(0))
            for i, j in K.chunks(off):
                for texts in cut.pieces(b.column(0).slice(i, j - i).to_pylist()):
                    data, s, e, _ = cut.split(texts)
                    short = (e - s <= LONGEST) & (data[s] != 0xED)  # special tokens begin so; a letter that does is merged
                    s, e = s[short], e[short]
                    # a clash of hashes could only change which words are frequent
                    _, first, n = np.unique(K.span_hashes(data, s, e, values, powers), return_index=True, return_counts=True)
                    raw = data.tobytes()
                    for a, z, k in zip(s[first].tolist(), e[first].tolist(), n.tolist(), strict=True):
                        w = raw[a:z]
                        total[w] = total.get(w, 0) + k
                    if len(total) > MEMO:
                        yield flush()
        yield flush()

    return rows


def frequent_words(docs: DataFrame, v: Vocabulary, most: int = LEXICON) -> list[bytes]:
    """At most ``most`` of the words of all texts: those whose count lies above
    the least bound that leaves so few.  The driver gets a histogram of counts
    (OCTAVE rows a doubling) and these words."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(v)
    rows = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    counts = materialize(rows.mapInArrow(_count_rows(sent), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    step = F.floor(F.log2("n") * OCTAVE).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"))
    w = Window.orderBy(F.desc("step"))  # a few hundred rows
    fit = steps.withColumn("upto", F.sum("words").over(w)).where(F.col("upto") <= most).agg(F.min("step").alias("least")).first()
    if fit.least is None:
        return []
    return [bytes(r.word) for r in counts.where(step >= fit.least).select("word").toLocalIterator()]


def publish(spark: SparkSession, lexicon: Lexicon) -> str:
    """Write the lexicon below the shared folder and let Spark ship it; the
    name under which tasks find their machine's copy."""
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{app_scratch_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(lexicon.to_bytes()))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


class Encoder:
    """Encodes chunks of texts: one walk for all words, merges for those not found."""

    def __init__(self, v: Vocabulary, lexicon: Lexicon) -> None:
        self.v, self.lexicon, self.words = v, lexicon, Words(v)
        self.fixed = {mark.encode("utf-8", "surrogatepass"): (v.special[s],) for s, mark in self.words.special.items()}
        self.memo: dict[bytes, tuple[int, ...]] = dict(self.fixed)
        self.merged = 0

    def _ids(self, word: bytes) -> tuple[int, ...]:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) > MEMO:
                self.memo = dict(self.fixed)
            got = merge_word(word, self.v)
            self.merged += 1
            if len(word) <= 4 * LONGEST:
                self.memo[word] = got
        return got

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        parts = [self._encode(p) for p in self.words.pieces(texts)]
        return parts[0] if len(parts) == 1 else [np.concatenate([p[0] for p in parts])]

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        data, s, e, first = self.words.split(texts)
        found, word, out = self.lexicon.walk(data, s, e)
        lost = np.flatnonzero(~found)
        raw = data.tobytes()
        own = [self._ids(raw[a:z]) for a, z in zip(s[lost].tolist(), e[lost].tolist(), strict=True)]
        base, sizes = len(self.lexicon.pool_at) - 1, np.array([len(x) for x in own], dtype=np.int64)
        pool = np.concatenate([self.lexicon.pool, np.array([i for x in own for i in x], dtype=np.int64)])
        at = np.r_[self.lexicon.pool_at, self.lexicon.pool_at[-1] + np.cumsum(sizes)]
        word, out = np.r_[word, lost], np.r_[out, base + np.arange(len(lost))]
        order = np.argsort(word, kind="stable")
        word, out = word[order], out[order]
        n = at[out + 1] - at[out]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.arange(total) + np.repeat(at[out] - (ends - n), n)].astype("<u4")
        per_word = np.bincount(word, weights=n, minlength=len(s)).astype(np.int64) if len(word) else np.zeros(len(s), dtype=np.int64)
        upto = np.r_[0, np.cumsum(per_word)][first]
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


def _encode_rows(vocabulary, lexicon: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value, Lexicon.mapped(SparkFiles.get(lexicon)))
        for b in batches:
            _, off = K.utf8_column(b.column(0))
            for i, j in K.chunks(off):
                part = b.slice(i, j - i)
                ids = encoder.encode(part.column(0).to_pylist())
                cols = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *cols], names=[*b.schema.names[1:], "ids", "n_tokens"])

    return rows


def encode(docs: DataFrame, v: Vocabulary, keep: list[str], lexicon_words: int = LEXICON) -> DataFrame:
    """The ``keep`` columns of ``docs`` with ids (little-endian unsigned 32-bit
    integers) and n_tokens of the whole text.

    Null or empty text: no ids.  Special tokens in a text become their ids.
    Very long texts and words: any length.  Ties in frequency decide only which
    words the lexicon has, never an id; repeated rows get equal ids.  Empty
    table: no rows.  Kept columns named like an added one are replaced; other
    columns are not read.  No text moves; the lexicon is bounded by
    ``lexicon_words``."""
    spark = docs.sparkSession
    keep = [c for c in keep if c.lower() not in ("ids", "n_tokens")]
    lexicon = Lexicon.build((w, merge_word(w, v)) for w in frequent_words(docs, v, lexicon_words))
    sent = spark.sparkContext.broadcast(v)  # a vocabulary file is a few MB
    rows = docs.select(F.col("text").cast("string").alias("__op_text"), *[F.col(c) for c in keep])
    schema = docs.select(*keep).withColumns({"ids": F.lit(b""), "n_tokens": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(_encode_rows(sent, publish(spark, lexicon)), schema)


def _decode_rows(tokens):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.value
        for b in batches:
            data, off = K.utf8_column(b.column(0))
            for i, j in K.chunks(off):
                texts = []
                for a, z in zip(off[i:j].tolist(), off[i + 1: j + 1].tolist(), strict=True):
                    texts.append(b" ".join([token[x] for x in np.frombuffer(data[a:z].tobytes(), dtype="<u4").tolist()]))
                cols = [x.slice(i, j - i) for x in b.columns[1:]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.binary()).cast(pa.string())], names=[*b.schema.names[1:], "decoded"])

    return rows


def decode(encoded: DataFrame, v: Vocabulary, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``encoded`` with decoded: the strings of the
    column ``ids``' tokens with a space between two, special ones included.

    Null or no ids: an empty text.  An id outside the vocabulary is an error.
    Kept columns named ``decoded`` are replaced.  No shuffle."""
    keep = [c for c in keep if c.lower() != "decoded"]
    sent = encoded.sparkSession.sparkContext.broadcast(v.tokens)
    schema = encoded.select(*keep).withColumn("decoded", F.lit("")).schema
    return encoded.select(F.col("ids").alias("__op_ids"), *[F.col(c) for c in keep]).mapInArrow(_decode_rows(sent), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_vocabulary()
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), v, ["doc_id"])
    ids = ids.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    texts = decode(ids, v, ["doc_id", "n_tokens", "ids_sha256"])
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
