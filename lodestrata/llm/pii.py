"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone numbers by pattern and check.
The field labels words by kind from their shapes and neighbours and adds what the patterns miss, such as
a number whose ``+`` was left out, or an address written with ``[at]``, ``(AT)`` or "at ... dot", in one word or several;
an added span overlaps no base span and has a plausible number of digits or parts; an address must be one once these words are
signs again. Base spans always stay.

Words without a digit, ``@``, ``+``, or "at" and "dot" in brackets, or "dot" alone, can only be labelled "other", unless they
are next to such a written sign. They cut the chain, so exact
Viterbi decoding runs over the short stretches between them, many at once as numpy batches.

The labelled table holds stretches of at most ``FIT_DOCS`` documents with such words (those with the lowest
hash of ``doc_id``), at most ``FIT_STRETCHES`` of them, labelled by the base spans; of up to ``VARIED`` of them copies without ``+``,
with ``00`` in its place and with the written forms of addresses are added, and look-alikes without an address. Training is gradient ascent on the penalised likelihood by forward-backward sums.

Positions count code points, ends are exclusive. Defined results: null and empty texts have no spans;
equal rows get equal results; of added spans, which do not overlap, each word has one label, so there are no ties; without any stretch to learn from, the base decides alone. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.spread import lowest_hashes
from lodestrata.llm.words import slices
from lodestrata.sources.workspace import materialise

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FIT_DOCS = 4000
FIT_STRETCHES = 1000
VARIED = 120
MOST_WORDS = 12  # of a written address
FIT_WORDS = 24  # longer stretches are decoded, but not learnt from
STEPS = 120
BATCH = 4096

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = r"[\[({](?:at|dot)[\])}]"
_HINT = re.compile(rf"[0-9@+]|{_SIGN}|(?<![^\x20\x09-\x0D])dot(?![^\x20\x09-\x0D])", re.IGNORECASE)
_AT = re.compile(rf"{_SIGN}|^dot$", re.IGNORECASE)
_AROUND = 3  # words before a written sign that belong to its stretch; one behind it does
_SIGNS = [(re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+", re.I), "@"), (re.compile(r"\s*[\[({]\s*dot\s*[\])}]\s*|\s+dot\s+", re.I), ".")]
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_GAP = re.compile(r"[\x20\x09-\x0D]*")
_BLANKS = frozenset("\x20\x09\x0a\x0b\x0c\x0d")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What the pattern ``local@domain`` finds from the left, in linear time: one look per ``@``."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four digit groups joined by single dots, from the left; groups above 255 drop the match."""
    run: list[re.Match] = []
    for group in _DIGITS.finditer(text):
        joined = run and group.start() == run[-1].end() + 1 and text[run[-1].end()] == "."
        run = [*run, group] if joined else [group]
        if len(run) == 4:
            if all(len(g.group().lstrip("0")) <= 3 and int(g.group().lstrip("0") or 0) <= 255 for g in run):
                yield run[0].start(), run[3].end()
            run = []


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    found += [("ip", *s) for s in addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = only_digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(only_digits(m.group())) <= 15]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@dataclass
class Stretch:
    """Neighbouring words that may hold personal data: places, words, and the words around them."""

    places: list[tuple[int, int]]
    words: list[str]
    before: str
    after: str


def stretches(text: str) -> list[Stretch]:
    places: list[list[tuple[int, int]]] = []

    def add(start: int, end: int) -> None:
        if places and _GAP.match(text, places[-1][-1][1]).end() == start:
            places[-1].append((start, end))
        else:
            places.append([(start, end)])

    hint = _HINT.search(text)
    while hint:
        start = hint.start()
        floor = places[-1][-1][1] if places else 0
        start = _word_start(text, start, floor)
        end = _WORD.match(text, start).end()
        written_ = _AT.search(text[start:end])
        if written_:
            earlier = []
            at = start
            while len(earlier) < _AROUND:
                stop = _end_before(text, at, floor)
                if stop <= floor:
                    break
                at = _word_start(text, stop - 1, floor)
                earlier.append((at, stop))
            for place in reversed(earlier):
                add(*place)
        add(start, end)
        if written_:
            behind = _WORD.search(text, end)
            if behind and not _HINT.search(text, behind.start(), behind.end()):
                add(*behind.span())
                end = behind.end()
        hint = _HINT.search(text, end)
    return [Stretch(p, [text[a:b] for a, b in p], _before(text, p[0][0]), _after(text, p[-1][1])) for p in places]


def _word_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] not in _BLANKS:
        at -= 1
    return at


def _end_before(text: str, at: int, floor: int) -> int:
    """The end of the last word before ``at``."""
    while at > floor and text[at - 1] in _BLANKS:
        at -= 1
    return at


def _before(text: str, start: int) -> str:
    words = text[max(0, start - 40) : start].split()
    return words[-1][-16:].lower() if words else ""


def _after(text: str, end: int) -> str:
    words = text[end : end + 40].split()
    return words[0][:16].lower() if words else ""


_SHAPES = [(re.compile(p), r) for p, r in ((r"[0-9]+", "9"), (r"[^\W\d_A-Z]+", "a"), (r"[A-Z]+", "A"))]


def shape(word: str) -> str:
    """Runs of digits, small letters and capitals as one character each."""
    for pattern, mark in _SHAPES:
        word = pattern.sub(mark, word)
    return word


def _written(word: str) -> str:
    """Which signs stand in a word in letters."""
    low = word.lower()
    signs = re.findall(_SIGN, low)
    return low if low in ("at", "dot") else "-".join(sorted({x[1:-1] for x in signs}))


def features(stretch: Stretch) -> list[list[str]]:
    """Names of the features of each word: its shapes, its digits, and those of its neighbours."""
    shapes = [shape(re.sub(_SIGN, lambda m: f"[{m[0][1:-1].lower()}]", w, flags=re.I)) for w in stretch.words]
    core = [s.strip(".,;:!?\"'") for s in shapes]
    out = []
    for i, word in enumerate(stretch.words):
        runs = [min(len(r), 20) for r in _DIGITS.findall(word)]
        out.append(
            [
                "bias",
                f"s={shapes[i][:40]}",
                f"c={core[i][:40]}",
                f"d={sum(runs)}",
                f"r={'-'.join(map(str, runs[:6]))}",
                f"@={'@' in word}|{_written(word)}",
                f"@p={_written(stretch.words[i - 1]) if i else ''}|@n={_written(stretch.words[i + 1]) if i + 1 < len(core) else ''}",
                f"f={word[:1] if not word[:1].isalnum() else shape(word[:1])}",
                f"p={core[i - 1][:40] if i else stretch.before}",
                f"n={core[i + 1][:40] if i + 1 < len(core) else stretch.after}",
                f"pc={core[i - 1][:40] if i else ''}|{core[i][:40]}",
                f"nc={core[i][:40]}|{core[i + 1][:40] if i + 1 < len(core) else ''}",
            ]
        )
    return out


def word_labels(stretch: Stretch, spans: list[Span]) -> list[int]:
    out = [0] * len(stretch.places)
    for kind, a, b in spans:
        inside = [i for i, (x, y) in enumerate(stretch.places) if x < b and a < y]
        for n, i in enumerate(inside):
            out[i] = LABELS.index(f"{'I' if n else 'B'}-{kind}")
    return out


@dataclass
class Field:
    """Weights of features by label and of label pairs."""

    index: dict[str, int]
    emit: np.ndarray
    step: np.ndarray

    def scores(self, stretch: Stretch) -> np.ndarray:
        return np.array([self.emit[[self.index[f] for f in names if f in self.index]].sum(0) for names in features(stretch)])

    def decode(self, stretches_: list[Stretch]) -> list[np.ndarray]:
        """The best labels of every stretch, by Viterbi over batches of similar length."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(stretches_)
        order = sorted(range(len(stretches_)), key=lambda i: len(stretches_[i].words))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            # lengths in a batch differ by a factor of two at most, so padding stays small
            while part:
                limit = 2 * len(stretches_[part[0]].words)
                now = [i for i in part if len(stretches_[i].words) <= limit]
                part = part[len(now) :]
                for i, labels in zip(now, self._viterbi([self.scores(stretches_[i]) for i in now]), strict=True):
                    out[i] = labels
        return out

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(s) for s in scores])
        rows, steps = len(scores), int(lengths.max())
        emit = np.zeros((rows, steps, len(LABELS)))
        for i, s in enumerate(scores):
            emit[i, : len(s)] = s
        best, back = emit[:, 0], np.zeros((rows, steps, len(LABELS)), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + self.step
            back[:, t] = paths.argmax(1)
            going = (t < lengths)[:, None]
            best = np.where(going, paths.max(1) + emit[:, t], best)
        labels = np.zeros((rows, steps), np.int64)
        label = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            labels[:, t] = label
            label = np.where(t < lengths, back[np.arange(rows), t, label], label) if t else label
        return [labels[i, :n] for i, n in enumerate(lengths)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(examples: list[tuple[Stretch, list[int]]], penalty: float = 1e-3, rate: float = 0.2) -> Field | None:
    """Maximum penalised likelihood by Adam steps over all examples; forward-backward in logarithms."""
    if not examples:
        return None
    names = [features(s) for s, _ in examples]
    index: dict[str, int] = {}
    for stretch in names:
        for word in stretch:
            for f in word:
                index.setdefault(f, len(index))
    lengths = np.array([len(y) for _, y in examples])
    rows, steps, size = len(examples), int(lengths.max()), len(LABELS)
    live = np.arange(steps) < lengths[:, None]
    gold = np.zeros((rows, steps), np.int64)
    at_word, at_feature = [], []
    for i, (stretch, (_, labels)) in enumerate(zip(names, examples, strict=True)):
        gold[i, : len(labels)] = labels
        for t, word in enumerate(stretch):
            at_word += [i * steps + t] * len(word)
            at_feature += [index[f] for f in word]
    word, feature = np.array(at_word), np.array(at_feature)
    weights = [np.zeros((len(index), size)), np.zeros((size, size))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    truth = np.eye(size)[gold] * live[:, :, None]
    pairs = (live[:, 1:]).ravel()
    true_steps = np.zeros((size, size))
    np.add.at(true_steps, (gold[:, :-1].ravel()[pairs], gold[:, 1:].ravel()[pairs]), 1)
    for n in range(1, STEPS + 1):
        emit = np.zeros((rows * steps, size))
        np.add.at(emit, word, weights[0][feature])
        emit = emit.reshape(rows, steps, size)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, steps):
            ahead[:, t] = np.where(live[:, t, None], _logsum(ahead[:, t - 1, :, None] + weights[1], 1) + emit[:, t], ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            on = _logsum(weights[1] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(live[:, t + 1, None], on, 0.0)
        total = _logsum(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - total[:, None, None]) * live[:, :, None]
        grad_emit = np.zeros_like(weights[0])
        np.add.at(grad_emit, feature, (truth - chance).reshape(-1, size)[word])
        grad_step = true_steps.copy()
        for t in range(1, steps):
            joint = ahead[:, t - 1, :, None] + weights[1] + (emit[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
            grad_step -= (np.exp(joint) * live[:, t, None, None]).sum(0)
        for w, g, (m, v) in zip(weights, (grad_emit, grad_step), moments, strict=True):
            g = g / rows - penalty * w
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            w += rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.999**n)) + 1e-8)
    return Field(index, *weights)


def variants(stretch: Stretch, labels: list[int]) -> Iterator[tuple[Stretch, list[int]]]:
    """The stretch, and how people write the same to escape a pattern."""
    yield stretch, labels
    if any(LABELS[y] == "B-phone" for y in labels):
        yield Stretch(stretch.places, [w.lstrip("+") or w for w in stretch.words], stretch.before, stretch.after), labels
        yield from _regrouped(stretch, labels)
        zero = ["00" + w[1:] if w.startswith("+") else w for w in stretch.words]
        yield Stretch(stretch.places, zero, stretch.before, stretch.after), labels
    if any(LABELS[y] == "B-email" for y in labels):
        for at, dot in ((" at ", " dot "), ("[at]", "."), (" [at] ", "."), ("(AT)", "."), ("{at}", "(dot)"), (" (at) ", " [dot] ")):
            yield _respelt(stretch, labels, at, dot, True)
            yield _respelt(_without_digits(stretch), labels, at, dot, True)
        yield _respelt(stretch, labels, " at ", " dot ", False)


def _without_digits(stretch: Stretch) -> Stretch:
    """Addresses of letters only; the last part of a domain has none."""
    words = [_ADDRESS.sub(lambda m: re.sub(r"\.?[0-9]+(?=[.@])", "", m[0]), w) for w in stretch.words]
    return Stretch(stretch.places, words, stretch.before, stretch.after)


def _respelt(stretch: Stretch, labels: list[int], at: str, dot: str, keep: bool) -> tuple[Stretch, list[int]]:
    """Addresses in words, with the signs written as given; without ``keep`` a look-alike: what follows the last sign is gone, and
    nothing is an address."""
    words: list[str] = []
    out: list[int] = []
    for word, label in zip(stretch.words, labels):
        found = _ADDRESS.search(word) if LABELS[label] == "B-email" else None
        if not found:
            words.append(word)
            out.append(label if keep or not LABELS[label].endswith("email") else 0)
            continue
        local, domain = found.group().split("@", 1)
        spelt = f"{local}{at}{domain.replace('.', dot)}" if keep else f"{local}{at}{domain.split('.')[0]}"
        parts = f"{word[: found.start()]}{spelt}{word[found.end() :]}".split()
        words += parts
        out += [label, *[label + 1] * (len(parts) - 1)] if keep else [0] * len(parts)
    return _amid(words, out, stretch)


def _amid(words: list[str], labels: list[int], stretch: Stretch) -> tuple[Stretch, list[int]]:
    """A stretch with the words around it, as written signs take them in."""
    before, after = ([w] if w else [] for w in (stretch.before, stretch.after))
    words = [*before, *words, *after]
    return Stretch([(0, 0)] * len(words), words, "", ""), [*([0] * len(before)), *labels, *([0] * len(after))]


def _regrouped(stretch: Stretch, labels: list[int]) -> Iterator[tuple[Stretch, list[int]]]:
    """A phone number alone in its stretch, in other groups of digits."""
    kinds = [LABELS[y] for y in labels]
    if kinds[0] != "B-phone" or set(kinds[1:]) - {"I-phone"}:
        return
    digits = only_digits(" ".join(stretch.words))
    for words in (["00" + digits[:2], digits[2:4], digits[4:]], [f"0{digits[1:4]}", digits[4:]], [f"0{digits[1:4]}", digits[4:7], digits[7:]], ["00" + digits]):
        yield Stretch([(0, 0)] * len(words), words, stretch.before, stretch.after), [labels[0], *[labels[0] + 1] * (len(words) - 1)]


def fit(docs: DataFrame) -> Field | None:
    own = docs.select("doc_id", "text")
    hinted = own.where(F.col("text").rlike(r"[0-9@+]")).select("doc_id").distinct()
    hinted = materialise(hinted, "hinted")
    chosen = lowest_hashes(hinted, hinted.count(), FIT_DOCS, "doc_id")
    chosen = materialise(chosen.withColumnRenamed("doc_id", "_doc"), "chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {"words": [], "labels": [], "before": [], "after": []}
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "")
                for s in stretches(text or ""):
                    unsure = any(_AT.search(w) for w in s.words)  # the patterns cannot label these
                    if not unsure and len(s.words) <= FIT_WORDS and max(map(len, s.words)) <= 200:
                        near = [x for x in spans if x[1] < s.places[-1][1] and s.places[0][0] < x[2]]
                        out["words"].append(s.words)
                        out["labels"].append(word_labels(s, near))
                        out["before"].append(s.before)
                        out["after"].append(s.after)
            types = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.string(), pa.string())
            yield pa.record_batch({k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)})

    texts_ = own.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi").select("text")  # FIT_DOCS ids
    table = texts_.mapInArrow(run, "words array<string>, labels array<int>, before string, after string")
    table = materialise(table.withColumn("key", F.to_json(F.struct("words", "before", "after"))), "stretches")
    rows = lowest_hashes(table, table.count(), FIT_STRETCHES, "key").collect()
    examples, left = [], VARIED
    for r in rows:
        own = list(variants(Stretch([(0, 0)] * len(r["words"]), list(r["words"]), r["before"], r["after"]), list(r["labels"])))
        examples += own if left > 0 else own[:1]
        left -= len(own) > 1
    return train(examples)


def _plausible(kind: str, text: str) -> bool:
    digits = len(only_digits(text))
    if kind == "email":
        for pattern, sign in _SIGNS:
            text = pattern.sub(sign, text)
        return bool(_ADDRESS.fullmatch(text))
    if kind == "ip":
        parts = _DIGITS.findall(text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 9 <= digits <= 15 if kind == "phone" else 12 <= digits <= 19 and luhn(only_digits(text))


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without signs at the ends that belong to the sentence."""
    while b > a and not text[b - 1].isalnum():
        b -= 1
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    return a, b


def added_spans(text: str, stretch: Stretch, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of the field's labels that overlap no base span."""
    out: list[Span] = []
    i = 0
    while i < len(labels):
        if not labels[i]:
            i += 1
            continue
        kind, first = LABELS[labels[i]][2:], i
        i += 1
        while i < len(labels) and LABELS[labels[i]] == f"I-{kind}":
            i += 1
        a, b = _trimmed(text, stretch.places[first][0], stretch.places[i - 1][1])
        if kind == "email" and 1 < i - first <= MOST_WORDS and not _plausible(kind, text[a:b]):
            # the longest address among the words of the span
            parts = [(x, y) for n in range(i - first - 1, 0, -1) for x in range(first, i - n + 1) for y in [x + n - 1]]
            runs = (_trimmed(text, stretch.places[x][0], stretch.places[y][1]) for x, y in parts)
            a, b = next((run for run in runs if _plausible(kind, text[run[0] : run[1]])), (a, b))
        if a < b and not any(x < b and a < y for _, x, y in base) and _plausible(kind, text[a:b]):
            out.append((kind, a, b))
    return out


def all_spans(texts_: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; the stretches of all texts are decoded together."""
    base = [base_spans(t) for t in texts_]
    if field is None:
        return [(b, b) for b in base]
    owned = [(i, s) for i, t in enumerate(texts_) for s in stretches(t)]
    more: list[list[Span]] = [[] for _ in texts_]
    for (i, stretch), labels in zip(owned, field.decode([s for _, s in owned]), strict=True):
        if labels.any():
            lo, hi = stretch.places[0][0], stretch.places[-1][1]
            more[i] += added_spans(texts_[i], stretch, labels, [s for s in base[i] if s[1] < hi and lo < s[2]])
    return [(b, ordered(b + m)) for b, m in zip(base, more, strict=True)]


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256, spans, n_added, n_spans`` per row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    field = field or fit(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = all_spans([t or "" for t in batch.column(1).to_pylist()], field)
            columns = {"doc_id": batch.column(0)}
            for kind in KINDS:
                columns[f"n_{kind}"] = pa.array([sum(s[0] == kind for s in b) for b, _ in found], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string())
            columns["spans"] = pa.array([written(a) for _, a in found], pa.string())
            columns["n_added"] = pa.array([len(a) - len(b) for b, a in found], pa.int64())
            columns["n_spans"] = pa.array([len(a) for _, a in found], pa.int64())
            yield pa.record_batch(columns)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return own.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long, n_spans long")


def redact(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in capitals; overlapping ones become one, named by the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame) -> DataFrame:
    """Documents with personal data replaced, columns as in ``documents``; null texts stay null."""
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    field = fit(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = batch.column(1).to_pylist()
            found = all_spans([t or "" for t in raw], field)
            clean = [t if t is None or not spans else redact(t, spans) for t, (_, spans) in zip(raw, found, strict=True)]
            sizes = [n if c is None or c is t else len(c) for t, c, n in zip(raw, clean, batch.column(4).to_pylist(), strict=True)]
            columns = [batch.column(0), pa.array(clean, pa.string()), batch.column(2), batch.column(3), pa.array(sizes, batch.column(4).type)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return own.mapInArrow(run, own.schema)
