"""PII: fixed patterns plus a linear-chain conditional random field over word shapes.

Tokens are words. A token without a digit and without ``@`` belongs to no kind, so
the chain falls apart at them, exactly, into short segments, which are decoded by
Viterbi in batches of equal length. The patterns' spans always stay; spans of the
field that touch none of them are added.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
MAX_TRAIN_ROWS = 5_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CANDIDATE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the run before it, back to the last match, and a domain behind it."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        at += 1
        if domain and start < at - 1:
            yield start, domain.end()
            done = at = domain.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and without overlap within a kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _shape(word: str) -> tuple[str, str]:
    """Letters and digits by class, with the lengths of digit runs and without."""
    mapped = re.sub(r"[a-z\u0080-\U0010ffff]+", "x", re.sub(r"[A-Z]+", "X", word[:60]))
    fine = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", mapped)
    return fine, re.sub(r"[0-9]+", "d", mapped)


_CUES = frozenset("phone tel telephone call fax mobile cell ip host server address card visa mastercard account email mail contact version no id order page year isbn".split())


def _traits(word: str, before: str, after: str) -> list[str]:
    core = word.strip(".,;:!?\"'")
    fine, coarse = _shape(core)
    digits = _digits(core)
    left, right = before.strip(".,;:!?\"'()#").lower(), after.strip(".,;:!?\"'()#").lower()
    return [
        "bias", "fine " + fine, "coarse " + coarse, f"digits {min(len(digits), 20)}", "first " + core[:1], "last " + core[-1:],
        f"luhn {13 <= len(digits) <= 19 and luhn(digits)}", f"octets {_octets(core)}", f"at {'@' in core}",
        "before " + (left if left in _CUES else _shape(left)[1][:12]), "after " + (right if right in _CUES else _shape(right)[1][:12]),
    ]


def _octets(word: str) -> bool:
    parts = re.split(r"[.:/]", word)[:4]
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)


def segments(text: str) -> list[list[tuple[int, int, list[str]]]]:
    """Runs of neighbouring candidate tokens on one line: start, end and traits of each."""
    runs: list[list[tuple[int, int, list[str]]]] = []
    last = -1
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if b - a > 200:
            last = -1
            continue
        left, right = text[max(0, a - 24) : a].split(), text[b : b + 24].split()
        token = (a, b, _traits(m[0], left[-1] if left else "", right[0] if right else ""))
        gap = text[last:a] if last >= 0 else "\n"
        if gap.strip() or "\n" in gap or len(gap) > 3:
            runs.append([])
        runs[-1].append(token)
        last = b
    return runs


class Field:
    """Weights of the conditional random field."""

    def __init__(self, traits: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.traits, self.emit, self.move = traits, emit, move

    def scores(self, run: list[tuple[int, int, list[str]]]) -> np.ndarray:
        return np.stack([self.emit[[self.traits[t] for t in token[2] if t in self.traits]].sum(axis=0) for token in run])

    def decode(self, runs: list[list[tuple[int, int, list[str]]]]) -> list[np.ndarray]:
        """Best labels of each run: Viterbi over all runs of one length at a time."""
        labels: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, run in enumerate(runs):
            by_length[len(run)].append(i)
        for length, members in by_length.items():
            e = np.stack([self.scores(runs[i]) for i in members])
            best, back = e[:, 0] + self.move[-1], []
            for t in range(1, length):
                step = best[:, :, None] + self.move[None, :-1, :]
                back.append(step.argmax(axis=1))
                best = step.max(axis=1) + e[:, t]
            path = [best.argmax(axis=1)]
            for pointers in reversed(back):
                path.append(np.take_along_axis(pointers, path[-1][:, None], 1)[:, 0])
            for i, row in zip(members, np.stack(path[::-1], axis=1)):
                labels[i] = row
        return labels


def _legal() -> np.ndarray:
    """Large penalties on I- labels that follow no label of their kind; the last row is the start."""
    move = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, to in enumerate(LABELS):
        for i, of in enumerate([*LABELS, "start"]):
            if to[0] == "I" and of[2:] != to[2:]:
                move[i, j] = -1e4
    return move


def fit(examples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 120, l2: float = 1e-3, rate: float = 0.1) -> Field:
    """Maximum likelihood by forward-backward over segments of equal length, with Adam."""
    runs, gold = [], []
    for text, spans in examples:
        for run in segments(text):
            labels = []
            for a, b, _ in run:
                own = next((s for s in spans if s[1] < b and a < s[2]), None)
                labels.append(0 if own is None else LABELS.index(("B-" if a <= own[1] or not labels or labels[-1] == 0 else "I-") + own[0]))
            runs.append(run)
            gold.append(np.array(labels))
    traits = {t: i for i, t in enumerate(sorted({t for run in runs for token in run for t in token[2]}))}
    n, legal = len(LABELS), _legal()
    emit, move = np.zeros((len(traits), n)), np.zeros((n + 1, n))
    groups: dict[int, list[int]] = defaultdict(list)
    for i, run in enumerate(runs):
        groups[len(run)].append(i)
    packed = []
    for length, members in groups.items():
        tokens = [token for i in members for token in runs[i]]
        owner = np.repeat(np.arange(len(tokens)), [len(t[2]) for t in tokens])
        packed.append((length, len(members), owner, np.array([traits[x] for t in tokens for x in t[2]]), np.stack([gold[i] for i in members])))
    free = np.concatenate([emit.ravel(), move.ravel()])
    first, second, total = np.zeros_like(free), np.zeros_like(free), max(1, len(runs))
    soft = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for step in range(1, rounds + 1):
        emit, move = free[: emit.size].reshape(emit.shape), free[emit.size :].reshape(move.shape)
        full = move + legal
        g_emit, g_move = -l2 * emit, -l2 * move
        for length, count, owner, index, y in packed:
            e = np.zeros((count * length, n))
            np.add.at(e, owner, emit[index])
            e = e.reshape(count, length, n)
            forward, backward = [e[:, 0] + full[-1]], [np.zeros((count, n))]
            for t in range(1, length):
                forward.append(soft(forward[-1][:, :, None] + full[None, :-1], 1) + e[:, t])
                backward.append(soft(full[None, :-1] + (e[:, length - t] + backward[-1])[:, None, :], 2))
            backward = backward[::-1]
            z = soft(forward[-1], 1)
            at = np.exp(np.stack(forward, 1) + np.stack(backward, 1) - z[:, None, None])
            truth = np.eye(n)[y]
            difference = (truth - at).reshape(-1, n) / total
            np.add.at(g_emit, index, difference[owner])
            g_move[-1] += (truth[:, 0] - at[:, 0]).sum(axis=0) / total
            for t in range(1, length):
                joint = np.exp(forward[t - 1][:, :, None] + full[None, :-1] + (e[:, t] + backward[t])[:, None, :] - z[:, None, None])
                g_move[:-1] += (truth[:, t - 1].T @ truth[:, t] - joint.sum(axis=0)) / total
        gradient = np.concatenate([g_emit.ravel(), g_move.ravel()])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        free = free + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(traits, free[: emit.size].reshape(emit.shape), free[emit.size :].reshape(move.shape) + legal)


def added_spans(text: str, runs: list, labels: list[np.ndarray], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the labels that touch no span of the patterns and hold as many digits as their kind can."""
    found = []
    for run, row in zip(runs, labels):
        at = 0
        while at < len(run):
            label, end = LABELS[row[at]], at
            if label != "O":
                while end + 1 < len(run) and LABELS[row[end + 1]] == "I-" + label[2:]:
                    end += 1
                a, b = run[at][0], run[end][1]
                while a < b and text[a] in "\"'<[{,;:":
                    a += 1
                while a < b and text[b - 1] in ".,;:!?\"'>]})" and not (text[b - 1] == ")" and "(" in text[a:b]):
                    b -= 1
                if _plausible(label[2:], text[a:b]) and not any(s[1] < b and a < s[2] for s in base):
                    found.append((label[2:], a, b))
            at = end + 1
    return found


def _plausible(kind: str, text: str) -> bool:
    n = len(_digits(text))
    if kind != "email" and any(c.isalpha() for c in text):
        return False
    if kind == "email":
        return "@" in text[1:-1]
    return {"ip": 4 <= n <= 17 and len(re.findall(r"[0-9]+", text)) >= 4, "card": 13 <= n <= 19, "phone": 7 <= n <= 15}[kind]


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _tag(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = [segments(t) for t in texts]
            labels = field.decode([r for runs in found for r in runs])
            rows, at = [], 0
            for text, runs in zip(texts, found):
                base = base_spans(text)
                extra = added_spans(text, runs, labels[at : at + len(runs)], base)
                at += len(runs)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(in_order(base + extra)), len(extra)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    return run


def labelled_examples(rows: int = 1_500, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The labelled table of the query: sentences drawn from a seeded grammar, with their spans.

    Each holds at most one item, in the forms people write it, or a number that is none.
    """
    rng = np.random.default_rng(seed)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("aeiorstnlmd"), rng.integers(2, 9)))

    def card(sep: str) -> str:
        body = "4" + digits(14)
        body += next(str(c) for c in range(10) if luhn(body + str(c)))
        return sep.join(body[i : i + 4] for i in range(0, 16, 4))

    def not_card() -> str:
        body = digits(16)
        return body if not luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10)

    def ip() -> str:
        return ".".join(str(x) for x in rng.integers(1, 255, 4))

    makers = [
        ("phone", lambda: f"+{rng.integers(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"), ("phone", lambda: f"{digits(3)}.{digits(3)}.{digits(4)}"),
        ("phone", lambda: f"+{rng.integers(1, 99)} {digits(3)} {digits(3)} {digits(4)}"), ("phone", lambda: f"1-{digits(3)}-{digits(3)}-{digits(4)}"),
        ("phone", lambda: f"+{rng.integers(1, 99)}{digits(10)}"), ("card", lambda: card("")), ("card", lambda: card(" ")), ("card", lambda: card("-")),
        ("card", lambda: card(".")), ("ip", ip), ("ip", lambda: ip() + f":{rng.integers(80, 9999)}"), ("ip", lambda: ip() + "/24"),
        ("email", lambda: f"{word()}.{digits(2)}@{word()}.{word()}.com"), ("email", lambda: f"{word()}@{word()}"), ("email", lambda: f"<{word()}@{word()}.org>"),
        (None, lambda: str(rng.integers(1900, 2030))), (None, lambda: digits(int(rng.integers(1, 7)))), (None, not_card), (None, lambda: digits(int(rng.integers(8, 13)))),
        (None, lambda: f"{digits(1)}.{digits(1)}.{digits(1)}"), (None, lambda: f"{digits(1)}.{digits(2)}"), (None, lambda: f"20{digits(2)}-0{digits(1)}-1{digits(1)}"),
        (None, lambda: f"1{digits(1)}:{digits(2)}"), (None, lambda: f"${digits(2)}.{digits(2)}"), (None, lambda: f"{digits(2)}%"), (None, lambda: word().upper() + digits(8) + word().upper()),
        (None, lambda: f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}"), (None, lambda: f"{digits(3)} {digits(3)} {digits(2)}"), (None, lambda: "@" + word()), (None, lambda: f"{digits(3)}/{digits(4)}"),
    ]
    cues = {"phone": ["call", "tel", "phone:", "fax"], "card": ["card", "visa"], "ip": ["host", "ip", "server"], "email": ["email", "mail", "contact"], None: ["no", "page", "order", "version", "year"]}
    out = []
    for i in range(rows):
        kind, make = makers[i % len(makers)]
        item = make()
        lead = " ".join(word() for _ in range(rng.integers(1, 5))) + " " + (rng.choice(cues[kind]) + " " if rng.random() < 0.3 else "")
        tail = (rng.choice([".", ",", "", ""]) + " " + " ".join(word() for _ in range(rng.integers(0, 4)))).rstrip(" ")
        out.append((lead + item + tail, [(kind, len(lead), len(lead) + len(item))] if kind else []))
    return out


EXAMPLES = "text string, spans array<struct<kind: string, start: int, stop: int>>"


def train(labelled: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Field:
    """Fit on a small labelled table (``EXAMPLES``), of which at most ``max_rows`` rows are read."""
    rows = labelled.where("text IS NOT NULL").limit(max_rows).collect()
    return fit(sorted((r["text"], [(s["kind"], s["start"], s["stop"]) for s in r["spans"] or []]) for r in rows))


def find_personal(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row of ``docs``.

    The counts and the digest are of the fixed patterns; ``spans`` has these and the
    ``n_added`` spans of the field, as kind:start:end in code points, by start. Null
    and empty texts have none. Words of more than 200 characters are left to the
    patterns. Ids are carried as they are, other columns are not read, an empty
    table gives no row.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return texts.mapInArrow(
        _tag(field), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    )


def personal_digest(docs: DataFrame) -> DataFrame:
    labelled = docs.sparkSession.createDataFrame(labelled_examples(), EXAMPLES)
    return find_personal(docs, train(labelled))
