"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds spans.

The tagger is trained in numpy from labelled spans: the base spans of a
bounded sample of documents, in windows of T characters, and the same spans
written as the patterns do not take them (``variants``): addresses with blanks
or a bracketed ``at``, IP parts apart or with bracketed dots, cards with other
separators or running on into a neighbouring number, phone numbers without
their international prefix.  Every digit, ``@`` and bracketed ``at`` of
a text is an anchor; the regions around anchors are cut into overlapping
windows, decoded by Viterbi, and each character takes the tag of the window
in whose middle it stands nearest.  An added span is widened to whole runs of
digits (a card to the longest valid one of neighbouring runs, an address to whole
names), must not touch a base span or an earlier added one, and must pass its
kind's check (digits, Luhn, parts of an address).

Defined results: a null or empty text has no spans; texts without anchors
are not decoded, as no kind can be without one; a very long text is decoded in
batches of windows, a byte kept for each of their characters; repeated rows are judged one
by one; without any labelled span the tagger adds none; extra columns are ignored.
"""

from __future__ import annotations

import io
import re
import zlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import add_columns, boxed, kept

KINDS = ["email", "ip", "card", "phone"]
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
T, STRIDE, REACH = 64, 40, 20
HIDDEN = 16
#: At most so many documents, and windows of each sort, are learned from.
SAMPLE_DOCS, SAMPLE_WINDOWS = 3000, 1200
EPOCHS, BATCH, RATE = 14, 64, 0.02
DECODE_BATCH = 1024
SYMBOLS = 99  # 0 pads; ASCII 32-126; line ends and tabs; other letters; other characters

EMAIL_LEFT = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a run of digits can start an address only at its first digit
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AT = r"[\[(](?:at|AT)[\])]"
ANCHOR = re.compile(f"[0-9@]+|{AT}")
# what an added span must look like
EMAIL_LIKE = re.compile(rf"[A-Za-z0-9._%+-]+ ?(?:@|{AT}) ?[A-Za-z0-9-]+(?: ?\. ?[A-Za-z0-9-]+)+")
IP_LIKE = re.compile(r"[0-9]+(?: ?(?:\.|\[\.\]) ?[0-9]+){3}")
CARD_LIKE = re.compile(r"[0-9]+(?:[ ._/-]{1,2}[0-9]+)*")
CARD_GAP = re.compile(r"[ ._/-]{1,2}")
PHONE_LIKE = re.compile(r"\+?[ ().0-9/-]+")
DIGITS = re.compile("[0-9]+")
DOMAIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-")
# texts with such a run outside the base spans are no examples of texts without personal data
DOUBTFUL = re.compile(r"[0-9][ ().0-9-]{7,}[0-9]")
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def small_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    d = digits_of(s)
    return 12 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans by start, then kind."""
    out: list[Span] = []
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in EMAIL_LEFT:
            start -= 1
        right = EMAIL_RIGHT.match(text, at + 1) if start < at else None
        if right:
            end = right.end()
            out.append((start, 0, end))
        at = max(at + 1, end)
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m.group())]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def windows(text: str) -> list[int]:
    """Starts of the windows over the regions around anchors."""
    out: list[int] = []
    done = -1  # end of the last region
    for m in ANCHOR.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if done >= a:  # the region goes on: windows go on at the stride
            a = out[-1] + STRIDE if out[-1] + T < b else b
        while a < b and (not out or out[-1] + T < b or done < a):
            out.append(a)
            done = b
            a += STRIDE
            if out[-1] + T >= b:
                break
        done = max(done, b)
    return out


_CODES = np.full(0x110000, SYMBOLS - 1, np.int16)
_CODES[0xAA:0x2FF] = SYMBOLS - 2
_CODES[32:127] = np.arange(1, 96)
_CODES[[9, 10, 11, 12, 13]] = 96


def encode(text: str, starts: list[int]) -> np.ndarray:
    out = np.zeros((len(starts), T), np.int64)
    for k, a in enumerate(starts):
        part = np.frombuffer(text[a:a + T].encode("utf-32-le"), np.uint32)
        out[k, :len(part)] = _CODES[part]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Bidirectional LSTM over symbols with a CRF layer; windows are padded with symbol 0, tagged outside."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"out": rng.normal(0, .2, (2 * h, TAGS)), "out0": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
        for d in "fb":
            self.p |= {f"in_{d}": rng.normal(0, .2, (SYMBOLS, 4 * h)), f"rec_{d}": rng.normal(0, .2, (h, 4 * h)),
                       f"bias_{d}": np.repeat([0., 1., 0., 0.], h)}

    def to_bytes(self) -> bytes:
        buf = io.BytesIO()
        np.savez(buf, **{k: v.astype(np.float32) for k, v in self.p.items()})
        return buf.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Tagger":
        out = cls()
        with np.load(io.BytesIO(data)) as f:
            out.p = {k: f[k] for k in f.files}
        return out

    def states(self, ids: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """Hidden states (window, position, unit) of one direction."""
        steps = range(T) if d == "f" else range(T - 1, -1, -1)
        n, h = len(ids), HIDDEN
        x = self.p[f"in_{d}"][ids] + self.p[f"bias_{d}"]
        hid, cell = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
        out = np.empty((n, T, h), x.dtype)
        for t in steps:
            z = x[:, t] + hid @ self.p[f"rec_{d}"]
            i, f, o = sigmoid(z[:, :h]), sigmoid(z[:, h:2 * h]), sigmoid(z[:, 2 * h:3 * h])
            g = np.tanh(z[:, 3 * h:])
            before, hid_before = cell, hid
            cell = f * cell + i * g
            tc = np.tanh(cell)
            hid = out[:, t] = o * tc
            if tape is not None:
                tape.append((t, i, f, o, g, before, tc, hid_before))
        return out

    def emissions(self, ids: np.ndarray, tapes: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([self.states(ids, d, None if tapes is None else tapes.setdefault(d, [])) for d in "fb"], 2)
        return both @ self.p["out"] + self.p["out0"], both

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tags of each window (Viterbi)."""
        e, _ = self.emissions(ids)
        score, back = e[:, 0], []
        for t in range(1, T):
            step = score[:, :, None] + self.p["trans"]
            back.append(step.argmax(1))
            score = step.max(1) + e[:, t]
        tags = np.empty(ids.shape, np.int8)
        tags[:, -1] = best = score.argmax(1)
        rows = np.arange(len(ids))
        for t in range(T - 2, -1, -1):
            tags[:, t] = best = back[t][rows, best]
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the negative log-likelihood of the tags, a window's mean."""
        n, h, tapes = len(ids), HIDDEN, {}
        e, both = self.emissions(ids, tapes)
        a, add = self.p["trans"], np.logaddexp.reduce
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, T):
            fwd[:, t] = e[:, t] + add(fwd[:, t - 1, :, None] + a, axis=1)
        for t in range(T - 2, -1, -1):
            bwd[:, t] = add(a + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
        z = add(fwd[:, -1], axis=1)
        de = np.exp(fwd + bwd - z[:, None, None])
        np.put_along_axis(de, tags[:, :, None], np.take_along_axis(de, tags[:, :, None], 2) - 1, 2)
        trans = np.zeros_like(a)
        for t in range(1, T):
            trans += np.exp(fwd[:, t - 1, :, None] + a + (e[:, t] + bwd[:, t])[:, None, :] - z[:, None, None]).sum(0)
            np.add.at(trans, (tags[:, t - 1], tags[:, t]), -1)
        de /= n
        g = {"trans": trans / n, "out": np.tensordot(both, de, ([0, 1], [0, 1])), "out0": de.sum((0, 1))}
        dboth = de @ self.p["out"].T
        for k, d in enumerate("fb"):
            dh_all = dboth[:, :, k * h:(k + 1) * h]
            dx = np.empty((n, T, 4 * h))
            g[f"rec_{d}"] = np.zeros((h, 4 * h))
            dh, dc = np.zeros((n, h)), np.zeros((n, h))
            for t, i, f, o, c, before, tc, hid_before in reversed(tapes[d]):
                dh = dh + dh_all[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * c * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - c * c)], 1)
                dx[:, t] = dz
                g[f"rec_{d}"] += hid_before.T @ dz
                dh, dc = dz @ self.p[f"rec_{d}"].T, dc * f
            g[f"bias_{d}"] = dx.sum((0, 1))
            g[f"in_{d}"] = np.zeros_like(self.p[f"in_{d}"])
            np.add.at(g[f"in_{d}"], ids, dx)
        return g

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS) -> "Tagger":
        """Stochastic gradient descent with Adam steps."""
        rng, step = np.random.default_rng(7), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for _ in range(max(epochs, min(60, -(-epochs * 1500 // max(1, len(ids)))))):
            order = rng.permutation(len(ids))
            for at in range(0, len(order), BATCH):
                step += 1
                pick = order[at:at + BATCH]
                for k, x in self.gradients(ids[pick], tags[pick]).items():
                    m[k] = .9 * m[k] + .1 * x
                    v[k] = .99 * v[k] + .01 * x * x
                    self.p[k] -= RATE * (m[k] / (1 - .9 ** step)) / (np.sqrt(v[k] / (1 - .99 ** step)) + 1e-8)
        return self


def tag_row(spans: list[Span], start: int) -> np.ndarray:
    row = np.zeros(T, np.int64)
    for a, kind, b in spans:
        lo, hi = max(a - start, 0), min(b - start, T)
        if lo < hi:
            row[lo:hi] = 2 + 2 * kind
            if a >= start:
                row[lo] = 1 + 2 * kind
    return row


def variants(kind: int, s: str, n: int) -> list[tuple[int, str, int, int]]:
    """A base span written as the patterns do not take it, in the n-th way: (sort, text, start, end),
    the personal data being text[start:end]."""
    whole = lambda sort, t: (sort, t, 0, len(t))
    if kind == 0:
        local, domain = s.split("@")
        return [whole(10, [f"{local} @ {domain}", f"{local}[at]{domain}", f"{local} (at) {domain}",
                           f"{local} @ {domain.replace('.', ' . ')}"][n % 4])]
    if kind == 1:
        return [whole(11, s.replace(".", [" . ", "[.]", ". "][n % 3]))]
    if kind == 2:
        d, sep = digits_of(s), [".", "/", "  ", "_"][n % 4]
        before, after = f"{100 + 7 * n % 900} ", f" {10 + 3 * n % 90}"
        return [whole(12, sep.join(d[k:k + 4] for k in range(0, len(d), 4))),
                (13, s + after, 0, len(s)) if n % 2 else (13, before + s, len(before), len(before) + len(s))]
    bare = s.split(" ", 1)[-1]
    return [whole(14, bare.replace(" ", "/") if n % 4 == 3 else bare)] if bare != s else []


def examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags: base spans of each kind, their variants, and none."""
    ids: dict[int, list[np.ndarray]] = {}
    tags: dict[int, list[np.ndarray]] = {}

    def add(sort: int, text: str, spans: list[Span]) -> None:
        for a in windows(text):
            row = tag_row(spans, a)
            if (row > 0).any() == (sort >= 0) and len(ids.setdefault(sort, [])) < SAMPLE_WINDOWS // len(KINDS):
                ids[sort].append(encode(text, [a])[0])
                tags.setdefault(sort, []).append(row)

    seen = [0] * len(KINDS)
    for text in texts:
        spans = base_spans(text)
        for a, kind, b in spans:
            lo, hi = max(0, a - T), min(len(text), b + T)
            near = [(x - lo, k, y - lo) for x, k, y in spans if x >= lo and y <= hi]
            add(kind, text[lo:hi], near)
            seen[kind] += 1
            for sort, form, x, y in variants(kind, text[a:b], seen[kind]) if len(near) == 1 else ():
                changed = text[lo:a] + form + text[b:hi]
                if not base_spans(changed):
                    add(sort, changed, [(a - lo + x, kind, a - lo + y)])
        if not spans and not DOUBTFUL.search(text):
            add(-1, text, [])
    return (np.array([r for k in sorted(ids) for r in ids[k]]).reshape(-1, T),
            np.array([r for k in sorted(tags) for r in tags[k]]).reshape(-1, T))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> bytes | None:
    """A tagger fitted in one task on at most ``sample`` documents with anchors; None if they hold no span."""
    with_anchor = docs.where(F.col(f"`{text_col}`").rlike(ANCHOR.pattern))
    chosen = (with_anchor.select(F.col(f"`{id_col}`").alias("chosen_id")).where("chosen_id IS NOT NULL")
              .orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(sample))
    rows = (with_anchor.select(F.col(f"`{id_col}`").alias("chosen_id"), F.col(f"`{text_col}`").alias("t"))
            .join(F.broadcast(chosen.distinct()), "chosen_id")
            # of an id's rows the least text, so that repeated rows cannot fill the one task that learns
            .groupBy("chosen_id").agg(F.min("t").alias("t")))

    def run(batches):
        got = sorted(((zlib.crc32(str(r["chosen_id"]).encode()), r["t"]) for b in batches for r in b.to_pylist()))
        ids, tags = examples([t for _, t in got[:sample]])
        if len(ids) and (tags > 0).any():
            yield pa.RecordBatch.from_arrays([pa.array([Tagger().fit(ids, tags).to_bytes()], pa.binary())], ["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0]["model"]) if found else None


def plausible(kind: int, s: str) -> bool:
    """Whether an added span can be of its kind."""
    if kind == 0:
        return bool(EMAIL_LIKE.fullmatch(s))
    if kind == 1:
        return bool(IP_LIKE.fullmatch(s)) and small_parts(".".join(DIGITS.findall(s)))
    if kind == 2:
        return bool(CARD_LIKE.fullmatch(s)) and is_card(s)
    return 9 <= len(digits_of(s)) <= 15 and any(c in " ().-/" for c in s) and bool(PHONE_LIKE.fullmatch(s))


def widened(text: str, kind: int, a: int, b: int) -> tuple[int, int] | None:
    """The span without white space and stops at its ends, widened to whole runs of digits or letters
    of names, cards to the longest valid one of runs nearby; None if it cannot be of its kind."""
    while a < b and text[a].isspace():
        a += 1
    while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
        b -= 1
    left, right = (EMAIL_LEFT, DOMAIN) if kind == 0 else ("0123456789", "0123456789")
    near_a, near_b = max(0, a - T), min(len(text), b + T)  # nothing of any kind has a run as long
    while near_a < a < b and text[a] in left and text[a - 1] in left:
        a -= 1
    while a < b < near_b and text[b - 1] in right and text[b] in right:
        b += 1
    if a == b or a == near_a > 0 or b == near_b < len(text):
        return None
    if kind == 2:
        runs = [(near_a + m.start(), near_a + m.end()) for m in DIGITS.finditer(text[near_a:near_b])]
        ends = [(x, y) for x, _ in runs if x <= a for _, y in runs if y >= b]
        found = [(x, y) for x, y in ends if CARD_LIKE.fullmatch(text, x, y) and is_card(text[x:y])]
        return max(found, key=lambda r: (r[1] - r[0], -r[0]), default=None)
    if kind == 1 and (re.match(r"\.[0-9]", text[b:b + 2]) or re.match(r"[0-9]\.", text[max(0, a - 2):a])):
        return None  # part of a longer row of numbers
    return (a, b) if plausible(kind, text[a:b]) else None


def reconciled(starts: list[int], tags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and tags of a text's characters in windows, each from the window whose middle is nearest
    (of two as near, the earlier one)."""
    a = np.array(starts)
    owned = np.minimum(a + T, length)
    owned[:-1] = np.minimum(owned[:-1], (a[:-1] + a[1:] + T - 1) // 2 + 1)
    first = np.maximum(a, np.concatenate(([0], (a[:-1] + a[1:] + T - 1) // 2 + 1)))
    grid = a[:, None] + np.arange(T)
    mine = (grid >= first[:, None]) & (grid < owned[:, None])
    return grid[mine], tags[mine]


def tagged_runs(positions: np.ndarray, tags: np.ndarray) -> list[Span]:
    """Runs of one kind, each from its begin tag, or the first inside tag, on."""
    at, tag = positions[tags > 0], tags[tags > 0]
    if not len(at):
        return []
    kind = (tag - 1) // 2
    new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(kind) != 0) | (tag[1:] % 2 == 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return list(zip(at[first].tolist(), kind[first].tolist(), (at[last] + 1).tolist()))


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger | None) -> list[list[Span]]:
    """Spans that the tagger adds to each text."""
    out: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return out
    starts = [windows(t) for t in texts]
    where = [(k, a) for k, s in enumerate(starts) for a in s]
    tags = np.empty((len(where), T), np.int8)
    for at in range(0, len(where), DECODE_BATCH):
        part = where[at:at + DECODE_BATCH]
        tags[at:at + len(part)] = tagger.decode(np.concatenate([encode(texts[k], [a]) for k, a in part]))
    done = 0
    for k, s in enumerate(starts):
        if not s:
            continue
        mine, done = tags[done:done + len(s)], done + len(s)
        begins = [a for a, _, _ in base[k]]
        reach = list(accumulate((b for _, _, b in base[k]), max))  # the furthest end of the spans so far
        free = 0
        for a, kind, b in tagged_runs(*reconciled(s, mine, len(texts[k]))):
            span = widened(texts[k], kind, a, b)
            if span is None or span[0] < free:
                continue
            before = bisect_left(begins, span[1])
            if before == 0 or reach[before - 1] <= span[0]:
                out[k].append((span[0], kind, span[1]))
                free = span[1]
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: bytes | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card and n_phone (base spans), base_spans and spans
    (kind:start:end in code points, end exclusive) and masked_text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        tagger = None
        if sent.value is not None:
            tagger = kept(("pii", zlib.crc32(sent.value)), lambda: Tagger.from_bytes(sent.value))

        def fn(texts):
            whole = [t or "" for t in texts]
            base = [base_spans(t) for t in whole]
            spans = [b + a for b, a in zip(base, added_spans(whole, base, tagger))]
            return [*[[sum(k == kind for _, k, _ in b) for b in base] for kind in range(len(KINDS))],
                    [listed(b) for b in base], [listed(s) for s in spans],
                    [t if t is None else masked(t, s) for t, s in zip(texts, spans)]]

        return fn

    return add_columns(docs, [text_col], "n_email long, n_ip long, n_card long, n_phone long, "
                       "base_spans string, spans string, masked_text string", make, keep)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    out = find(docs, train(docs), keep=["doc_id"])
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def mask(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every span masked in the text, and n_chars (if there) brought up to date."""
    out = find(boxed(docs, text=text_col), train(docs, id_col, text_col), keep=["row"])
    made, changed = F.col("masked_text"), F.col("spans") != ""
    return out.select(*[
        made.alias(c) if c == text_col else
        F.when(changed, F.length(made)).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns])
