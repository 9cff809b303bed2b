"""Personal data: exact patterns, and a linear-chain conditional random field that adds to them.

The field labels tokens (runs of letters or digits, single signs) by their word shapes and those of
their neighbours. It is trained from the small labelled table below and decoded by Viterbi for many
sequences at once. Tokens over which no span can weigh as much as O are surely O on the best path of
the whole text, so the text is cut there and only the parts between are decoded. Its spans count only if they do not touch a pattern's span and hold what their
kind must hold, so it adds loosely written addresses and numbers and leaves other digits alone.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.base import column, extended, query, table

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"@|(?<![^\W\d_])[aA][tT](?![^\W\d_])")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of local part, @, domain; searched from the signs, so in linear time."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _holds(kind: str, text: str) -> bool:
    """What a span of a kind must hold."""
    if kind == "email":
        return _AT.search(text) is not None
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)
    digits = _NOT_DIGIT.sub("", text)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The patterns' spans per kind, leftmost and not overlapping within a kind."""
    found = {"email": list(_emails(text)) if "@" in text else []}
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        found[kind] = [m.span() for m in pattern.finditer(text) if _holds(kind, m[0])]
    return found


# Labelled table of the field: texts whose spans are marked as <kind:...>.
LABELLED = (
    "write to <email:jo.81@mail7.example.com> today",
    "mail <email:anna_b@host.example.org>, please",
    "ask <email:k-li (at) mail3.example.com> for it",
    "reach <email:pat.9 [at] web.example.net> soon",
    "send it to <email:max77 (at) post2.example.org>.",
    "her address is <email:lea.4 [at] mail8.example.com> now",
    "server <ip:10.20.30.40> is down",
    "from <ip:226.203.165.104> came",
    "host <ip:192-168-17-45> answered",
    "login by <ip:172 . 16 . 254 . 3> failed",
    "pay with <card:4111 1111 1111 1111> now",
    "card <card:4111111111111111> was used",
    "number <card:5500/0000/0000/0004> on file",
    "card no. <card:4012.8888.8888.1881>, valid",
    "call <phone:+1 (017) 555-7713> later",
    "phone <phone:+49 30 1234567> or mail",
    "call <phone:(212) 555-0187> tonight",
    "her number: <phone:(617) 555-0134>.",
    "tel. <phone:212-555-0187> works",
    "ring <phone:415-555-0199>, then wait",
    "fax <phone:001 212 555 0142> is old",
    "licensed under CC BY-NC 4.0.",
    "Apache License, Version 2.0.",
    "version 3 of the license",
    "in 1998 and 2004 we had 12 of them",
    "on 2024-01-15 at 10:45 we met",
    "pages 101-117, volume 23, issue 4",
    "order 20240115 was sent on 3/4/2021",
    "it cost 1,234,567.89 or 12.50 each",
    "section 3.4.5.6 and table 2.1",
    "build 1.20.300 is out, 1.20.301 follows",
    "number 9807915762804490 of the list",
    "ids 7536784127813050 4845168114407329 follow",
    "isbn 978-3-16-148410-0 is a book",
    "part 555-0187 and code 12-345-6789-01",
    'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" is set',
    "see @anna and @bo_12 there",
    "meet at 5 (at) noon, 10 of us",
    "a 4x4 grid has 16 cells",
    "score 21-17, 21-19 in 45 minutes",
    "lat 48.8566 lon 2.3522",
    "call 911 or 112 in need",
    "room (212) on floor 5-6",
    "between 100 200 300 and 400",
    "1 2 3 4 5 6 7 8 9 10",
    "from 1990-1994 to 1995-1999",
    "win 10,000 or 20,000 points",
    "the 2nd of 3 in B2B and A4",
    "mail me @ home, 3 @ 2 each",
    "write to <email:anna (at) host (dot) example (dot) org> today",
    "ask <email:bo.li [at] mail [dot] example [dot] com>, please",
    "reach <email:max_k (at) web.example.net> soon",
    "we met at noon and sat at home",
    "the dot at the end (at last) is a dot",
    "look at it: a dot, at most, and no more",
    "plain words stand here, and more words follow them.",
    "He said (quietly) that they left. She stayed [again] at home.",
)

_MARK = re.compile(r"<(\w+):([^>]*)>")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\s]")
_PIECE = re.compile(r"[^\W\d_]+|\d+|\s+|[^\s]")
_LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Every span that counts has one of these: @ or at in an address, digits in the other kinds.
_NEEDED = re.compile(r"[0-9]|" + _AT.pattern)
EPOCHS = 40
#: Cells (sequences x longest) decoded together, and tokens scored together.
CELLS = 1 << 18
#: Different neighbourhoods whose weights a worker remembers.
REMEMBERED = 100_000


def _tokens(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


def _pieces(text: str, step: int = 1 << 20):
    """Lists of pieces (tokens and runs of white space) that make up the text, for a part at a time."""
    begin, size = 0, step
    while True:
        pieces = _PIECE.findall(text, begin, begin + size)
        if begin + size >= len(text):
            yield pieces
            return
        if len(pieces) == 1:  # goes on beyond the part, maybe
            size *= 2
            continue
        whole = begin + size - len(pieces.pop())
        yield pieces
        begin, size = whole, step


def _shape(piece: str) -> str:
    if piece[0].isdigit():
        return "9" * min(len(piece), 5)
    if piece[0].isalpha():
        if piece.lower() in ("at", "dot"):
            return piece.lower()
        return ("A" if piece[0].isupper() else "a") + ("a" if len(piece) > 1 else "")
    return piece if piece in "@+-.()[]/:,_%=\"" else "#"


def _features(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    shapes = [_shape(text[a:b]) for a, b in spans]
    joins = ["" if i and spans[i - 1][1] == spans[i][0] else "_" for i in range(len(spans))]
    padded = ["<<", "<", *shapes, ">", ">>"]
    glued = ["_", "_", *joins, "_", "_"]
    return [_named(padded[i : i + 5], glued[i + 1 : i + 5]) for i in range(len(spans))]


def _named(shapes: list[str], gaps: list[str]) -> list[str]:
    """Features of a token from five shapes, its own in the middle, and the gaps between them."""
    far, left, here, right, last = shapes
    far_gap, gap, next_gap, last_gap = gaps
    return [
        "bias",
        "0" + here,
        "-1" + left + gap,
        "+1" + next_gap + right,
        "-10" + left + gap + here,
        "+01" + here + next_gap + right,
        "-101" + left + gap + here + next_gap + right,
        "-2-10" + far + far_gap + left + gap + here,
        "+012" + here + next_gap + right + last_gap + last,
    ]


def _labelled(marked: str):
    """Text and label per token of a marked text."""
    text, spans, last = "", [], 0
    for m in _MARK.finditer(marked):
        text += marked[last : m.start()]
        spans.append((len(text), len(text) + len(m[2]), m[1]))
        text += m[2]
        last = m.end()
    text += marked[last:]
    tokens, labels = _tokens(text), []
    for a, b in tokens:
        label = 0
        for s, e, kind in spans:
            if s <= a and b <= e:
                label = _LABELS.index(("B-" if a == s else "I-") + kind)
        labels.append(label)
    return text, tokens, labels


class Field:
    """Weights of features per label and of label pairs; forbidden pairs weigh -1e4."""

    def __init__(self, names: dict[str, int]):
        n = len(_LABELS)
        self.names = names
        self.weights = np.zeros((len(names) + 1, n))  # the last row is for unknown features
        self.pairs = np.zeros((n, n))
        self.closed = np.zeros((n, n))
        for j, label in enumerate(_LABELS):
            if label[0] == "I":
                self.closed[:, j] = -1e4
                self.closed[[j - 1, j], j] = 0
        self.first = np.array([-1e4 if label[0] == "I" else 0.0 for label in _LABELS])

    def ids(self, features: list[list[str]]) -> np.ndarray:
        get, unknown = self.names.get, len(self.names)
        return np.array([[get(f, unknown) for f in row] for row in features], np.int64)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each sequence of feature ids."""
        return self.paths([len(s) for s in sequences], lambda i, a, b: self.weights[sequences[i][a:b]].sum(axis=1))

    def paths(self, sizes: list[int], emitted) -> list[np.ndarray]:
        """Best labels of sequences, all of a group step by step; `emitted` gives the weights of a
        part of a sequence.

        Groups are bounded by sequences x longest. Weights are held for a block of steps only; what
        a long sequence keeps is the running state and one byte per token and label.
        """
        out: list = [None] * len(sizes)
        order = sorted(range(len(sizes)), key=lambda i: sizes[i])
        n = len(_LABELS)
        move = self.pairs + self.closed
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and b - a < 256 and (b - a + 1) * sizes[order[b]] <= CELLS:
                b += 1
            part, a = order[a:b], b
            longest = sizes[part[-1]]
            lengths = np.array([sizes[i] for i in part])
            block = max(1, CELLS // len(part))
            back = np.zeros((longest, len(part), n), np.int8)
            best = np.zeros((len(part), n))
            for begin in range(0, longest, block):
                end = min(longest, begin + block)
                emit = np.zeros((end - begin, len(part), n))
                for row, i in enumerate(part):
                    if sizes[i] > begin:
                        emit[: min(end, sizes[i]) - begin, row] = emitted(i, begin, min(end, sizes[i]))
                for t in range(begin, end):
                    if t == 0:
                        best = emit[0] + self.first
                        continue
                    paths = best[:, :, None] + move
                    back[t] = paths.argmax(axis=1)
                    live = (t < lengths)[:, None]
                    best = np.where(live, paths.max(axis=1) + emit[t - begin], best)
            for row, i in enumerate(part):
                labels = np.zeros(sizes[i], np.int8)
                label = int(best[row].argmax())
                for t in range(sizes[i] - 1, -1, -1):
                    labels[t] = label
                    label = int(back[t, row, label])
                out[i] = labels
        return out


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=2)
def train(table_: tuple[str, ...] = LABELLED, epochs: int = EPOCHS, penalty: float = 1e-3) -> Field:
    """Maximise the conditional likelihood of the labelled table by adaptive gradient steps."""
    data = []
    names: dict[str, int] = {}
    for marked in table_:
        text, tokens, labels = _labelled(marked)
        features = _features(text, tokens)
        for row in features:
            for f in row:
                names.setdefault(f, len(names))
        data.append((features, np.array(labels)))
    field = Field(names)
    n = len(_LABELS)
    squares, pair_squares = np.full_like(field.weights, 1e-2), np.full((n, n), 1e-2)
    rng = np.random.default_rng(3)
    data = [(field.ids(f), y) for f, y in data]
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            ids, y = data[k]
            emit = field.weights[ids].sum(axis=1)
            move = field.pairs + field.closed
            forward, backward = np.zeros_like(emit), np.zeros_like(emit)
            forward[0] = emit[0] + field.first
            for t in range(1, len(y)):
                forward[t] = emit[t] + _logsum(forward[t - 1][:, None] + move, 0)
            for t in range(len(y) - 2, -1, -1):
                backward[t] = _logsum(move + (emit[t + 1] + backward[t + 1])[None, :], 1)
            total = _logsum(forward[-1], 0)
            gradient = np.exp(forward + backward - total)
            gradient[np.arange(len(y)), y] -= 1
            pair_gradient = np.zeros((n, n))
            for t in range(1, len(y)):
                joint = forward[t - 1][:, None] + move + (emit[t] + backward[t])[None, :] - total
                pair_gradient += np.exp(joint)
                pair_gradient[y[t - 1], y[t]] -= 1
            change = np.zeros_like(field.weights)
            np.add.at(change, ids, np.broadcast_to(gradient[:, None, :], (*ids.shape, n)))
            touched = np.unique(ids)
            g = change[touched] + penalty * field.weights[touched]
            squares[touched] += g**2
            field.weights[touched] -= 0.2 * g / np.sqrt(squares[touched])
            g = pair_gradient + penalty * field.pairs
            pair_squares += g**2
            field.pairs -= 0.2 * g / np.sqrt(pair_squares)
    field.weights[-1] = 0
    return field


_PADS = ("<<", "<", ">", ">>")


class Scorer:
    """Weights of the field for tokens, remembered by the shapes and gaps around them."""

    def __init__(self, field: Field):
        self.field = field
        self.shapes = {name: i for i, name in enumerate(_PADS)}
        self.codes: dict[str, int] = {}
        self._bound_pairs()
        self._clear()

    def _bound_pairs(self):
        """The most that pair weights can give to a span, compared with O throughout, per kind: on
        entering it, for each further token, and on leaving it."""
        pairs, move = self.field.pairs, self.field.pairs + self.field.closed
        b, i = np.arange(1, len(_LABELS), 2), np.arange(2, len(_LABELS), 2)
        outer = np.concatenate(([0], b))
        self.enter = (move - move[:, :1]).max(axis=0)[b]
        self.more = np.maximum(pairs[b, i], pairs[i, i]) - pairs[0, 0]
        leave = (move[:, outer] - move[:1, outer]).max(axis=1).clip(0)
        self.leave = np.maximum(leave[b], leave[i])

    def _clear(self):
        self.rows: dict[int, int] = {}
        self.emit = self.gain = np.empty((0, len(_LABELS)))

    def code(self, piece: str) -> int:
        """Number of a piece's shape, negative for white space."""
        found = self.codes.get(piece)
        if found is None:
            found = -1 if piece[0].isspace() else self.shapes.setdefault(_shape(piece), len(self.shapes))
            if len(self.codes) < REMEMBERED:
                self.codes[piece] = found
        return found

    def places(self, text: str):
        """Borders of the tokens, the row of weights of each, and which of them a span may need."""
        parts, begin = [], 0
        for pieces in _pieces(text):
            codes = list(map(self.codes.get, pieces))
            if None in codes:
                codes = [self.code(p) if c is None else c for p, c in zip(pieces, codes)]
            shape = np.array(codes, np.int64)
            ends = begin + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            starts = np.concatenate(([begin], ends[:-1]))
            begin = int(ends[-1])
            token = shape >= 0
            parts.append((starts[token], ends[token], shape[token]))
        start, end, shape = (np.concatenate(x) for x in zip(*parts))
        n = len(shape)
        if not n:
            return start, end, shape, shape > 0
        padded = np.concatenate(([0, 1], shape, [2, 3]))
        glued = np.ones(n + 4, np.int64)
        glued[3 : n + 2] = start[1:] != end[:-1]
        around = np.zeros(n, np.int64)
        for k in range(5):
            around = around * 64 + padded[k : n + k]
        for k in range(1, 5):
            around = around * 2 + glued[k : n + k]
        different, inverse = np.unique(around, return_inverse=True)
        needed = np.array([name[0] == "9" or name in ("@", "at") for name in self.shapes])
        return start, end, self._numbered(different)[inverse], needed[shape]

    def segments(self, rows: np.ndarray, needed: np.ndarray) -> list[tuple[int, int]]:
        """Parts of a sequence that may hold a span that counts, each between two tokens that the
        best path surely labels O (they are part of it), or to the sequence's end.

        A token is surely O if, for each kind, even the best span over it, wherever it begins and
        ends, weighs less than O in its place. The best begin and end are found for all tokens at
        once by running maxima over running sums.
        """
        n = len(rows)
        gain = self.gain
        maybe = np.zeros(n, bool)
        for kind in range(len(KINDS)):
            sums = np.cumsum((gain[:, 2 + 2 * kind] + self.more[kind])[rows])
            begin = (gain[:, 1 + 2 * kind] + self.enter[kind])[rows]
            begin[0] += max(0.0, -self.enter[kind])
            best_begin = np.maximum.accumulate(begin - sums)
            best_end = np.maximum.accumulate(sums[::-1])[::-1]
            maybe |= best_begin + best_end + self.leave[kind] > -1e-4
        open_ = np.flatnonzero(maybe)
        if not len(open_):
            return []
        borders = np.flatnonzero(np.diff(open_) > 1)
        begins = open_[np.concatenate(([0], borders + 1))]
        ends = open_[np.concatenate((borders, [len(open_) - 1]))] + 1
        seen = np.concatenate(([0], np.cumsum(needed)))
        use = seen[ends] > seen[begins]
        begins, ends = np.maximum(begins[use] - 1, 0), np.minimum(ends[use] + 1, n)
        return list(zip(begins.tolist(), ends.tolist()))

    def weights(self, rows: np.ndarray, first: bool, last: bool) -> np.ndarray:
        """Weights of tokens; a first or last one that is surely O admits no other label."""
        emit = self.emit[rows]
        if first:
            emit[0, 1:] = -1e9
        if last:
            emit[-1, 1:] = -1e9
        return emit

    def _numbered(self, around: np.ndarray) -> np.ndarray:
        new = [x for x in around.tolist() if x not in self.rows]
        if new:
            names = list(self.shapes)
            ids = []
            for x in new:
                self.rows[x] = len(self.rows)
                gaps = ["_" if x >> 3 - k & 1 else "" for k in range(4)]
                p = [names[x >> 4 + 6 * (4 - k) & 63] for k in range(5)]
                ids.append(_named(p, gaps))
            emit = self.field.weights[self.field.ids(ids)].sum(axis=1)
            self.emit = np.concatenate((self.emit, emit))
            self.gain = self.emit - self.emit[:, :1]
        return np.array([self.rows[x] for x in around.tolist()], np.int64)


@lru_cache(maxsize=2)
def _scorer(field: Field) -> Scorer:
    return Scorer(field)


def find_spans(texts: list[str | None], field: Field) -> list[tuple[dict, dict]]:
    """Pattern spans and added spans of each text, by kind."""
    known = [base_spans(text or "") for text in texts]
    added: list[dict] = [{kind: [] for kind in KINDS} for _ in texts]
    scorer = _scorer(field)
    if len(scorer.rows) > REMEMBERED:
        scorer._clear()
    waiting, held = [], 0
    for i, text in enumerate(texts):
        if _NEEDED.search(text or ""):
            start, end, rows, needed = scorer.places(text)
            for a, b in scorer.segments(rows, needed):
                emit = (rows[a:b].copy(), a > 0, b < len(rows))
                waiting.append((i, start[a:b].copy(), end[a:b].copy(), emit))
                held += b - a
        if held > 4 * CELLS or i == len(texts) - 1:
            _decode(waiting, scorer, texts, known, added)
            waiting, held = [], 0
    return list(zip(known, added))


def _decode(waiting, scorer: Scorer, texts, known, added) -> None:
    """Add the spans of the field in segments of texts (index, borders of tokens, rows of weights)."""

    def emitted(k, a, b):
        rows, first, last = waiting[k][3]
        return scorer.weights(rows[a:b], first and a == 0, last and b == len(rows))

    found = scorer.field.paths([len(w[1]) for w in waiting], emitted)
    taken = {i: sorted(s for spans in known[i].values() for s in spans) for i in {w[0] for w in waiting}}
    for (i, start, end, _), labels in zip(waiting, found):
        spots, t = np.flatnonzero(labels).tolist(), -1
        for begin in spots:
            if begin < t:
                continue
            kind, t = KINDS[(labels[begin] - 1) // 2], begin + 1
            while t < len(labels) and labels[t] and labels[t] % 2 == 0:
                t += 1
            a, b = int(start[begin]), int(end[t - 1])
            if _holds(kind, texts[i][a:b]) and not _touches(taken[i], a, b):
                added[i][kind].append((a, b))


def _touches(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    return any(s < b and a < e for s, e in spans)


def _joined(*groups: dict) -> str:
    return ",".join(
        f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(x for g in groups for x in g[kind])
    )


def personal_data(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """To each row without its text: the numbers of pattern spans per kind, `base` and `spans`.

    `base` lists the patterns' spans as kind:start:end in code points, end exclusive, by kind and
    start; `spans` lists those and the field's, likewise. Null or empty texts have none. Whole texts
    are read; repeated rows are answered alike; an empty table gives no rows.
    """
    keys = [name for name in documents.columns if name != "text"]
    shared = documents.sparkSession.sparkContext.broadcast(field or train())

    def rows(batches):
        field = shared.value
        for batch in batches:
            found = find_spans(column(batch, "text").to_pylist(), field)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, name) for name in keys),
                    *(pa.array([len(b[kind]) for b, _ in found], pa.int64()) for kind in KINDS),
                    pa.array([_joined(b) for b, _ in found], pa.string()),
                    pa.array([_joined(b, a) for b, a in found], pa.string()),
                ],
                names=[*keys, *(f"n_{kind}" for kind in KINDS), "base", "spans"],
            )

    return documents.mapInArrow(
        rows,
        extended(
            documents.drop("text").schema,
            "n_email long, n_ip long, n_card long, n_phone long, base string, spans string",
        ),
    )


@query()
def op6_pii(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")
