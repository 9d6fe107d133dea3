"""Operator 9: personal data by fixed patterns and a BiLSTM-CRF over characters.

The patterns find e-mail addresses, IP addresses, card and phone numbers.  A
character-level bidirectional LSTM with CRF transitions, trained in numpy from
labelled spans, reads the text in overlapping windows and adds forms that the
patterns miss, such as ``name at host dot org`` or a phone number without ``+``.
A span that it finds must have what its kind needs (``plausible``).
Windows are decoded alone; their spans are then reconciled over the whole text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW, STRIDE = 160, 96  # code points; a span of up to 64 lies whole in a window
CROP = 80  # code points of a training example
#: Bound on the labelled rows that reach the driver for training: windows with and without spans.
MOST_LABELLED, MOST_CLEAN = 400, 200
MADE_UP = 4000  # written forms and look-alikes put into the sample's texts
STEPS, BATCH, EMBED, HIDDEN = 300, 96, 12, 20
LEAST_SCORE = 0.2  # mean margin over "outside" of an added span

Span = tuple[int, int, int]  # start, end, kind number

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its first digit only; starts inside it end alike
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Written forms of "@" and "."; a bare word counts for "@" only where one counts for "." after it.
AT = r"(?:@|[(\[{<] ?at ?[)\]}>])"
DOT = r"(?:\.|[(\[{<] ?(?:dot|\.) ?[)\]}>])"
#: Every form of the four kinds holds a digit, an at sign or a written one.
TRIGGER = re.compile(r"[0-9@]|[(\[{<] ?[aA][tT] ?[)\]}>]|\b[aA][tT] (?=[A-Za-z0-9-]{1,40} (?:[dD][oO][tT]|[(\[{<] ?[dD][oO][tT]))")
EMAIL_FORM = re.compile(rf"[a-z0-9._%+-]+(?: ?{AT} ?[a-z0-9-]+(?:(?: ?{DOT} ?| dot )[a-z0-9-]+)+| at [a-z0-9-]+(?: dot [a-z0-9-]+| ?[(\[{{<] ?dot ?[)\]}}>] ?[a-z0-9-]+)+)", re.I)
IP_FORM = re.compile(rf"[0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}}", re.I)
CARD_FORM = re.compile(r"[0-9]+(?:[ ./-][0-9]+)*")
PHONE_FORM = re.compile(r"(?:\+|00 ?)?(?:\([0-9]{1,5}\)|[0-9]{1,5})(?:[ ./-]{0,2}(?:\([0-9]{1,5}\)|[0-9]{2,8}))*")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def valid_card(s: str) -> bool:
    if len(s) > 64:
        return False
    digits = re.sub(r"[^0-9]", "", s)
    return 12 <= len(digits) <= 19 and luhn(digits)


def valid_ip(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in s.split("."))


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns by start, then kind; linear in the text."""
    out: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            done = m.end()
        at = text.find("@", at + 1)
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if valid_ip(m[0])]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if m.end() - m.start() <= 37 and valid_card(m[0])]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


# --- the network -----------------------------------------------------------


def symbols(text: str) -> np.ndarray:
    """0 past the text, 1 line break or tab, 2 other letters, 3 other signs, then ASCII."""
    x = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    out = np.where((x >= 32) & (x < 127), x - 28, np.where(x < 32, 1, 2))
    return np.where((x >= 0x2000) & (x < 0x3000) | (x == 127), 3, out).astype(np.int16)


N_SYMBOLS = 127 - 28


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _lstm(x: np.ndarray, wh: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """x: steps x batch x 4H of input sums.  States, and what the way back needs."""
    steps, batch, four = x.shape
    n = four // 4
    h, c = np.zeros((batch, n), dtype=x.dtype), np.zeros((batch, n), dtype=x.dtype)
    out, held = np.empty((steps, batch, n), dtype=x.dtype), []
    for t in range(steps):
        z = x[t] + h @ wh
        s = _sigmoid(z[:, : 3 * n])
        i, f, o = s[:, :n], s[:, n: 2 * n], s[:, 2 * n:]
        g = np.tanh(z[:, 3 * n:])
        before, prev = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            held.append((i, f, o, g, before, tc, prev))
    return out, held


def _lstm_back(d_out: np.ndarray, wh: np.ndarray, held: list) -> tuple[np.ndarray, np.ndarray]:
    steps, batch, n = d_out.shape
    dx, dwh = np.empty((steps, batch, 4 * n), dtype=d_out.dtype), np.zeros_like(wh)
    dh, dc = np.zeros((batch, n), dtype=d_out.dtype), np.zeros((batch, n), dtype=d_out.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, prev = held[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dx[t] = dz
        dwh += prev.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return dx, dwh


def allowed() -> np.ndarray:
    """0 for possible transitions, -1e4 for a span that goes on without a begin."""
    a = np.zeros((LABELS, LABELS), dtype=np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        for before in range(LABELS):
            if before not in (inside - 1, inside):
                a[before, inside] = -1e4
    return a


def initial(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.3, (N_SYMBOLS, EMBED)), "trans": np.zeros((LABELS, LABELS)), "out": rng.normal(0, 0.2, (2 * HIDDEN, LABELS)), "bias": np.zeros(LABELS)}
    for d in ("fw", "bw"):
        p[d + "_x"] = rng.normal(0, 0.3, (EMBED, 4 * HIDDEN))
        p[d + "_h"] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        p[d + "_b"] = np.zeros(4 * HIDDEN)
        p[d + "_b"][HIDDEN: 2 * HIDDEN] = 1.0  # remember at first
    return {k: v.astype(np.float32) for k, v in p.items()}


def emissions(p: dict[str, np.ndarray], x: np.ndarray, keep: bool = False):
    """x: steps x batch symbols.  Label scores: steps x batch x LABELS."""
    e = p["embed"][x]
    fw, held_f = _lstm(e @ p["fw_x"] + p["fw_b"], p["fw_h"], keep)
    bw, held_b = _lstm(e[::-1] @ p["bw_x"] + p["bw_b"], p["bw_h"], keep)
    h = np.concatenate([fw, bw[::-1]], axis=2)
    return h @ p["out"] + p["bias"], (e, h, held_f, held_b)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def posteriors(score: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities (steps x batch x LABELS), expected transitions, log Z."""
    steps = len(score)
    a, b = np.empty_like(score), np.zeros_like(score)
    a[0] = score[0]
    for t in range(1, steps):
        a[t] = score[t] + _logsum(a[t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        b[t] = _logsum(trans + (score[t + 1] + b[t + 1])[:, None, :], 2)
    z = _logsum(a[-1], 1)
    moves = np.zeros_like(trans)
    for t in range(1, steps):
        moves += np.exp(a[t - 1][:, :, None] + trans + (score[t] + b[t])[:, None, :] - z[:, None, None]).sum(axis=0)
    return np.exp(a + b - z[None, :, None]), moves, z


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of labels ``y`` (steps x batch) and its gradients."""
    score, (e, h, held_f, held_b) = emissions(p, x, keep=True)
    steps, batch, _ = score.shape
    trans = p["trans"] + allowed()
    prob, moves, z = posteriors(score, trans)
    t_at, b_at = np.arange(steps)[:, None], np.arange(batch)[None, :]
    gold = score[t_at, b_at, y].sum(axis=0) + trans[y[:-1], y[1:]].sum(axis=0)
    d = prob
    d[t_at, b_at, y] -= 1
    d /= batch
    np.add.at(moves, (y[:-1].ravel(), y[1:].ravel()), -1)
    g = {"trans": moves / batch, "out": np.einsum("tbh,tbl->hl", h, d), "bias": d.sum(axis=(0, 1))}
    dh = d @ p["out"].T
    dx_f, g["fw_h"] = _lstm_back(dh[:, :, :HIDDEN], p["fw_h"], held_f)
    dx_b, g["bw_h"] = _lstm_back(dh[::-1, :, HIDDEN:], p["bw_h"], held_b)
    de = dx_f @ p["fw_x"].T + (dx_b @ p["bw_x"].T)[::-1]
    g["fw_x"], g["fw_b"] = np.einsum("tbe,tbz->ez", e, dx_f), dx_f.sum(axis=(0, 1))
    g["bw_x"], g["bw_b"] = np.einsum("tbe,tbz->ez", e[::-1], dx_b), dx_b.sum(axis=(0, 1))
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], x, de)
    return float((z - gold).mean()), g


def fit(examples: list[tuple[str, list[Span]]], steps: int = STEPS, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam over random batches of labelled texts of at most CROP code points."""
    rng = np.random.default_rng(seed)
    p = initial(seed)
    x = np.zeros((len(examples), CROP), dtype=np.int16)
    y = np.zeros((len(examples), CROP), dtype=np.int64)
    for r, (text, spans) in enumerate(examples):
        s = symbols(text[:CROP])
        x[r, : len(s)] = s
        for a, b, k in spans:
            y[r, a:b] = 2 + 2 * k
            y[r, a] = 1 + 2 * k
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(examples), BATCH)
        _, g = gradients(p, x[pick].T, y[pick].T)
        norm = float(np.sqrt(sum((a * a).sum() for a in g.values())))
        rate = 0.02 * min(1.0, 1.5 - step / steps)
        for k in p:
            grad = g[k] * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.99 * v[k] + 0.01 * grad * grad
            p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return p


# --- labelled examples -----------------------------------------------------


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(str(d) for d in rng.integers(0, 10, n))


def _name(rng: np.random.Generator) -> str:
    return "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(2, 9))))


def made_up(rng: np.random.Generator) -> tuple[str, int | None]:
    """A written form and its kind, or a look-alike that is no personal data."""
    pick = lambda *xs: xs[int(rng.integers(0, len(xs)))]
    form = int(rng.integers(0, 20))
    name, host = _name(rng), [_name(rng), *([_name(rng)] if rng.random() < 0.3 else []), _name(rng)[:3] if rng.random() < 0.5 else pick("com", "org", "net", "info", "example")]
    if rng.random() < 0.4:
        name += pick(".", "_", "-", "") + (_name(rng) if rng.random() < 0.7 else _digits(rng, 2))
    area, mid, end = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    if form < 3:
        at = pick(" (at) ", " [at] ", "(at)", "[at]", " @ ", "{at}", " {at} ", "<at>", " (AT) ")
        return f"{name}{at}{'.'.join(host)}", 0
    if form < 5:
        at, dot = pick((" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}"), (" @ ", " dot "), (" (AT) ", " (DOT) "))
        return name + at + dot.join(host), 0
    if form < 7:
        at, dot = pick((" at ", " dot "), (" AT ", " DOT "), (" at ", " (dot) "))
        return name + at + dot.join(host), 0
    if form == 7:
        return f"{name}@{'.'.join(host)}", 0
    if form == 8:
        return pick(f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"{area} {mid} {end}"), 3
    if form == 9:
        return f"{pick('+', '00')}{rng.integers(1, 99)} {pick('', '(0)')}{area} {mid}{pick(' ', '-')}{end}", 3
    if form in (10, 11, 12):  # national numbers: a zero, then groups of one rule
        groups = pick([2, 4, 4], [1, 2, 2, 2, 2], [3, 3, 4], [3, 4, 3], [2, 3, 4], [3, 7], [2, 8])
        sep = pick(" ", " ", "-", ".")
        parts = [_digits(rng, g) for g in groups]
        parts[0] = "0" + parts[0]
        if rng.random() < 0.2:
            parts[0] = f"({parts[0]})"
        return sep.join(parts), 3
    if form == 13:
        return pick(".", "[.]", "(.)").join(str(x) for x in rng.integers(0, 256, 4)), 1
    if form in (14, 15):
        body = _digits(rng, 15)
        last = next(d for d in "0123456789" if luhn(body + d))
        sep = "" if form == 14 else pick(" ", "-", ".", "/")
        full = body + last
        return sep.join(full[i: i + 4] for i in range(0, 16, 4)), 2
    if form == 16:
        return pick(f"{2000 + int(rng.integers(0, 25))}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", f"{rng.integers(1, 29)}.{rng.integers(1, 13)}.{rng.integers(1950, 2030)}", " ".join(str(x) for x in rng.integers(1900, 2030, 3)), f"{rng.integers(1, 999)},{_digits(rng, 3)},{_digits(rng, 3)}"), None
    if form == 17:
        return pick(f"version {rng.integers(1, 9)}.{rng.integers(0, 9)}", f"at {_name(rng)} the dot of {_name(rng)}", f"{_name(rng)} at {_name(rng)}", f"(at {_name(rng)})"), None
    if form == 18:
        return f'"{hashlib.md5(_digits(rng, 6).encode()).hexdigest()}"', None
    return pick(_digits(rng, int(rng.integers(1, 8))), f"id {_digits(rng, int(rng.integers(9, 13)))}", f"{_digits(rng, 2)}:{_digits(rng, 2)}:{_digits(rng, 2)}"), None


def augment(sample: list[tuple[str, list[Span]]], made: int = MADE_UP, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """The sample, and ``made`` cuts with one more form in front of a span or at
    a space, half of them in its texts and half in lines of made-up words."""
    rng = np.random.default_rng(seed)
    out = list(sample)
    for n in range(made):
        text, spans = sample[int(rng.integers(0, len(sample)))] if sample and n % 2 else ("", [])
        if not text:
            text = " ".join(_name(rng) + ("" if rng.random() < 0.85 else ".,:;"[int(rng.integers(0, 4))]) for _ in range(int(rng.integers(1, 18))))
        form, kind = made_up(rng)
        places = [i for i, c in enumerate(text) if c == " " and not any(a <= i < b for a, b, _ in spans)] + [len(text)]
        at = places[int(rng.integers(0, len(places)))]
        lead = "" if at and text[at - 1] == " " else " "
        after = text[at:] if rng.random() < 0.8 else ".,;)"[int(rng.integers(0, 4))] + text[at:]
        new = text[:at] + lead + form + after
        begin, grown = at + len(lead), len(new) - len(text)
        if any(a < at < b for a, b, _ in spans):  # the end of a cut inside a span
            continue
        moved = [(a + grown, b + grown, k) if a >= at else (a, b, k) for a, b, k in spans]
        if kind is not None:
            moved.append((begin, begin + len(form), kind))
        lo = max(0, min(begin - int(rng.integers(0, 40)), len(new) - CROP)) if len(new) > CROP else 0
        out.append((new[lo: lo + CROP], [(a - lo, b - lo, k) for a, b, k in moved if a >= lo and b <= lo + CROP]))
    return out


def _label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts of CROP code points around digits and at signs with the pattern's spans."""
    for b in batches:
        rows = []
        for text in b.column(0).to_pylist():
            if not TRIGGER.search(text):
                continue
            spans = base_spans(text)
            for lo in sorted({max(0, a - 24) for a, _, _ in spans} | ({max(0, TRIGGER.search(text).start() - 30)})):
                crop = text[lo: lo + CROP]
                whole = [(a - lo, e - lo, k) for a, e, k in spans if a >= lo and e <= lo + CROP]
                cut = any(a < lo + CROP and e > lo and not (a >= lo and e <= lo + CROP) for a, e, _ in spans)
                clash = any(x[0] < y[1] and y[0] < x[1] for i, x in enumerate(whole) for y in whole[:i])
                if not cut and not clash:
                    rows.append((int.from_bytes(hashlib.blake2b(crop.encode(), digest_size=7).digest(), "big"), bool(whole), crop, [x for s in whole for x in s]))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.int32()))], names=["h", "marked", "crop", "spans"])


def labelled_sample(docs: DataFrame) -> list[tuple[str, list[Span]]]:
    """At most MOST_LABELLED cuts with spans and MOST_CLEAN without, by hash over all documents."""
    rows = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]")).mapInArrow(_label_rows, "h long, marked boolean, crop string, spans array<int>")
    out = []
    ranked = rows.groupBy("marked", "h").agg(F.first("crop").alias("crop"), F.first("spans").alias("spans"))
    for marked, most in ((True, MOST_LABELLED), (False, MOST_CLEAN)):
        for r in ranked.where(F.col("marked") == marked).orderBy("h").limit(most).collect():
            out.append((r.crop, [tuple(r.spans[i: i + 3]) for i in range(0, len(r.spans), 3)]))
    return out


# --- decoding --------------------------------------------------------------


def viterbi(score: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels (steps x batch)."""
    steps, batch, _ = score.shape
    back = np.empty(score.shape, dtype=np.int8)
    best = score[0].copy()
    best[:, 2::2] -= 1e4  # no window begins inside a span
    for t in range(1, steps):
        every = best[:, :, None] + trans
        back[t] = every.argmax(axis=1)
        best = every.max(axis=1) + score[t]
    out = np.empty((steps, batch), dtype=np.int8)
    out[-1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][np.arange(batch), out[t]]
    return out


@dataclass
class Tagger:
    params: dict[str, np.ndarray]

    def windows(self, x: np.ndarray, batch: int = 256) -> Iterator[tuple[int, list[tuple[int, int, int, float]]]]:
        """For each window (rows of symbols) its spans and their scores."""
        trans = self.params["trans"] + allowed()
        for at in range(0, len(x), batch):
            score, _ = emissions(self.params, x[at: at + batch].T)
            label = viterbi(score, trans)
            margin = np.take_along_axis(score, label[:, :, None].astype(np.int64), axis=2)[:, :, 0] - score[:, :, 0]
            for r in np.flatnonzero((label > 0).any(axis=0)):
                line, found, t = label[:, r], [], 0
                while t < len(line):
                    if line[t] % 2 == 1:
                        e = t + 1
                        while e < len(line) and line[e] == line[t] + 1:
                            e += 1
                        found.append((t, e, (int(line[t]) - 1) // 2, float(margin[t:e, r].mean())))
                        t = e
                    else:
                        t += 1
                yield at + int(r), found


def plausible(s: str, kind: int) -> bool:
    """Whether an added span has what its kind needs."""
    if kind == 0:
        return bool(EMAIL_FORM.fullmatch(s))
    if kind == 1:
        return bool(IP_FORM.fullmatch(s)) and all(int(x) <= 255 for x in re.findall("[0-9]+", s))
    if kind == 2:
        return bool(CARD_FORM.fullmatch(s)) and valid_card(s)
    return len(s) <= 40 and bool(PHONE_FORM.fullmatch(s)) and 9 <= sum("0" <= c <= "9" for c in s) <= 15


def reconcile(text: str, found: list[tuple[int, int, int, float, float]], base: list[Span]) -> list[Span]:
    """Spans of all windows of a text: parts of one kind that overlap are
    united, then the best score wins, then the one nearest a window's middle.
    Base spans stay, and nothing that overlaps one is added."""
    merged: list[list] = []
    latest: dict[int, list] = {}  # of each kind; by start, so no earlier one reaches further
    for a, b, k, s, off in sorted(found):
        last = latest.get(k)
        if last and a < last[1]:
            last[1], last[3], last[4] = max(last[1], b), max(last[3], s), min(last[4], off)
        else:
            latest[k] = [a, b, k, s, off]
            merged.append(latest[k])
    # disjoint intervals in order: the last one that begins before an end tells whether any overlaps
    taken: list[tuple[int, int]] = []
    for a, b, _ in sorted(base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    out = []
    for a, b, k, s, off in sorted(merged, key=lambda m: (-round(m[3], 4), m[4], m[0], m[2])):
        b = min(b, len(text))  # a last window is padded past its text
        while a < b and text[a].isspace():
            a += 1
        while a < b and text[b - 1].isspace():
            b -= 1
        if a >= b or s < LEAST_SCORE:
            continue
        inside_word = a > 0 and text[a - 1].isalnum() or b < len(text) and text[b].isalnum()
        if inside_word or not plausible(text[a:b], k):
            continue
        place = bisect_left(taken, (b,))
        if place and taken[place - 1][1] > a:
            continue
        taken.insert(place, (a, b))
        out.append((a, b, k))
    return out


def _find_rows(params, keep: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(params.value)
        for b in batches:
            for at in range(0, len(b), 2000):
                part = b.slice(at, 2000)
                texts = [t or "" for t in part.column(0).to_pylist()]
                base: list[list[Span]] = [[] for _ in texts]
                win, place = [], []
                found: list[list] = [[] for _ in texts]

                def decode() -> None:
                    if win:
                        for w, spans in tagger.windows(np.stack(win)):
                            d, lo = place[w]
                            found[d] += [(lo + a, lo + e, k, s, abs((a + e) / 2 - WINDOW / 2)) for a, e, k, s in spans]
                        win.clear()
                        place.clear()

                for d, t in enumerate(texts):
                    if not TRIGGER.search(t):
                        continue
                    base[d] = base_spans(t)
                    # windows on a fixed grid over the whole text; those without a trigger hold no span
                    need = sorted({w for m in TRIGGER.finditer(t) for w in range(max(0, (m.start() - WINDOW) // STRIDE + 1), m.start() // STRIDE + 1)})
                    for w in need:
                        s = symbols(t[w * STRIDE: w * STRIDE + WINDOW])
                        win.append(np.pad(s, (0, WINDOW - len(s))))
                        place.append((d, w * STRIDE))
                        if len(win) >= 4096:
                            decode()
                decode()
                added = [reconcile(t, f, s) if f else [] for t, f, s in zip(texts, found, base, strict=True)]
                kept = [part.column(k) for k in range(1, 1 + keep)]
                counts = [pa.array([sum(s[2] == k for s in spans) for spans in base], pa.int64()) for k in range(len(KINDS))]
                sha = [hashlib.sha256(written(s).encode()).hexdigest() for s in base]
                every = [written(sorted(s + x, key=lambda s: (s[0], s[2]))) for s, x in zip(base, added, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *counts, pa.array(sha, pa.string()), pa.array(every, pa.string()), pa.array([len(x) for x in added], pa.int64())],
                                                 names=[*part.schema.names[1:], "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return rows


def find(docs: DataFrame, params: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs`` with the numbers of base spans by kind,
    base_sha256, spans (kind:start:end of all, in code points, end exclusive)
    and n_added (those of the network).

    Whole texts are read: windows cover each place that a digit, an at sign or
    a written one is in.  Null or empty text: no spans.  Of spans that overlap the
    better score stays, of equal ones that nearer the middle of its window, then
    the earlier.  No shuffle; equal rows get equal results; empty table: no rows.
    Columns of ``keep`` named like an added one, in any case, are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(params)
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    keep = [c for c in keep if c.lower() not in names]
    rows = docs.select(F.col("text").cast("string").alias("__op_text"), *[F.col(c) for c in keep])
    zero = F.lit(0).cast("long")
    schema = docs.select(*keep).withColumns({n: F.lit("") if n in ("base_sha256", "spans") else zero for n in names}).schema
    return rows.mapInArrow(_find_rows(sent, len(keep)), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    params = fit(augment(labelled_sample(docs)))
    return find(docs, params, ["doc_id"])
