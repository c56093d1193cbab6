"""Operator 5, personal data by fixed patterns and a semi-Markov conditional random field.

The base patterns find well-formed addresses and numbers, and what they find stays. Around other
digits and signs the field looks for what they miss: written-out addresses, numbers with unusual
separators. It scores whole candidate segments (their shape, digit counts, groups, checks and
neighbours), and a dynamic program over segments of bounded size chooses boundaries and kinds
jointly. It is trained here, by likelihood, on a bounded sample of passages whose
base spans are the labels, half of them rewritten as people disguise or vary such data.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.llm.batches import drawn, map_batches, text_slices

KINDS = ("email", "ip", "card", "phone")
#: Atoms of a segment at most; passages and rounds of training; the log odds that a found segment must have.
MAX_ATOMS, SAMPLE_PASSAGES, ROUNDS, MARGIN = 24, 400, 4, 3.0
#: Code points of a training passage at most, and documents that passages are drawn from (expected number).
PASSAGE, SAMPLE_DOCS = 200, 20_000

#: Shapes of segments whose scores a worker remembers; then it starts anew. This bounds memory and changes no result.
REMEMBERED = 100_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ATOM = re.compile(r"[A-Za-zÀ-\U0010FFFF]+|[0-9]+|.", re.S)
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile("[0-9]+")
_AT = re.compile(r"(?<![A-Za-z])(?:at)(?![A-Za-z])", re.I)
_DOT = re.compile(r"(?<![A-Za-z])(?:dot|punkt|punto|point)(?![A-Za-z])", re.I)
#: A bare word for "at" counts where a dot inside a name or between blanks, or a word for one, follows within the atoms that one segment can hold.
_TRIGGER = re.compile(
    rf"[0-9@]|[(\[{{]at[)\]}}]|{_AT.pattern}(?=(?:[A-ZÀ-\U0010FFFF]++|[0-9]++|[^\nA-ZÀ-\U0010FFFF0-9]){{1,{MAX_ATOMS}}}?(?:\.(?=[A-Z0-9])|(?<=\s)\.(?=\s)|{_DOT.pattern}))|{_DOT.pattern}", re.I
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _byte(digits: str) -> bool:
    short = digits.lstrip("0") or "0"
    return len(short) <= 3 and int(short) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, place in KINDS) by start, then kind; ends are exclusive. Linear in the text."""
    found = [(a, b, 0) for a, b in _emails(text)]
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def regions(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of two words on either side of what may be personal data outside ``taken``."""
    out: list[list[int]] = []
    k, n = 0, len(taken)
    at = 0
    while m := _TRIGGER.search(text, at):
        while k < n and taken[k][1] <= m.start():
            k += 1
        if k < n and taken[k][0] <= m.start():
            at = taken[k][1]
            continue
        start, end = m.start(), m.end()
        for _ in range(3):
            start = _back(text, start)
        w = end
        for _ in range(3):
            w = _ahead(text, w)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], w)
        else:
            out.append([start, w])
        rest = _WORD.match(text, m.end())
        at = rest.end() if rest else m.end()
    return [(a, b) for a, b in out]


def _back(text: str, at: int) -> int:
    while at and text[at - 1] in " \t\n\x0b\x0c\r":
        at -= 1
    while at and text[at - 1] not in " \t\n\x0b\x0c\r":
        at -= 1
    return at


def _ahead(text: str, at: int) -> int:
    m = _WORD.search(text, at)
    return m.end() if m else len(text)


def _gaps(found: list[tuple[int, int]], taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the spans taken leave of regions in order; both are walked once."""
    k = 0
    for a, b in found:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        at = k
        while at < len(taken) and taken[at][0] < b:
            if taken[at][0] > a:
                yield a, taken[at][0]
            a = max(a, taken[at][1])
            at += 1
        if a < b:
            yield a, b


def features(span: str, before: str, after: str) -> list[str]:
    """Whole-segment features, before they are paired with a kind."""
    digits = re.sub("[^0-9]", "", span)
    shape = re.sub("[A-Za-zÀ-\U0010ffff]+", "a", span)
    runs = re.sub("[0-9]+", lambda m: f"<{min(len(m.group()), 20)}>", shape)
    marks = "".join(sorted(set(re.sub("[0-9a<>]", "", runs))))
    n, groups = len(digits), runs.count("<")
    word = re.findall(r"[^\W\d_]+", before[-24:])
    ats, dots = span.count("@") + len(_AT.findall(span)), span.count(".") + len(_DOT.findall(span))
    out = [
        "bias", f"runs={runs[:48]}", f"shape={re.sub('<[0-9]+>', '9', runs)[:48]}", f"marks={marks}", f"digits={n}", f"groups={min(groups, 8)}",
        f"ats={min(ats, 2)}", f"dots={min(dots, 5)}", f"first={_kind(span[0])}", f"last={_kind(span[-1])}", f"left={_kind(before[-1:])}", f"right={_kind(after[:1])}",
        f"letters={min(sum(c.isalpha() for c in span), 3)}", f"blanks={min(span.count(' '), 8)}", f"ats={min(ats, 2)},dots={min(dots, 2)},tail={_tail(span)}", f"digits={n},marks={marks}", f"digits={n},groups={min(groups, 8)}",
    ]
    if word:
        out.append(f"word={word[-1].lower()}")
    if 12 <= n <= 19:
        out.append(f"luhn={luhn(digits)},groups={min(groups, 8)}")
    parts = re.split(r"[^0-9]+", span.strip("[](){} "))
    if len(parts) == 4 and all(p and _byte(p) for p in parts):
        out.append(f"four={marks}")
    return out


def _kind(c: str) -> str:
    return "none" if not c else "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def _tail(span: str) -> str:
    tail = re.search(r"[A-Za-z]*$", span).group()
    return "long" if len(tail) > 4 else str(len(tail))


def _atom_shape(atom: str) -> str:
    """What the features of a segment need to know of an atom."""
    if atom.isascii() and atom.isalpha():
        low = atom.lower()
        return low if _AT.fullmatch(low) or _DOT.fullmatch(low) else "aaaaa"[: len(atom)]
    return f"<{min(len(atom), 20)}>" if atom[0] in "0123456789" else atom


class Candidates:
    """The segments of ``text[a:b]`` that the field scores.

    A segment has ``MAX_ATOMS`` atoms at most, no line break, and no blank or bracket at its edges; it holds a sign or word for "@", or as many
    digits as a number of some kind has: nine to nineteen, or four and more between three dots. These tests need sums up to each atom only.
    """

    def __init__(self, text: str, a: int, b: int) -> None:
        self.text = text
        self.bounds = [a, *(m.end() for m in _ATOM.finditer(text, a, b))]
        atoms = [text[x:y] for x, y in zip(self.bounds, self.bounds[1:])]
        self.shapes = [_atom_shape(x) for x in atoms]
        self.pairs: list[tuple[int, int]] = []
        digits, ats, dots = [0], [0], [0]
        for x in atoms:
            word = len(x) > 1 and x[0] not in "0123456789"
            digits.append(digits[-1] + (len(x) if x[0] in "0123456789" else 0))
            ats.append(ats[-1] + (len(_AT.findall(x)) if word else x == "@"))
            dots.append(dots[-1] + (len(_DOT.findall(x)) if word else x == "."))
        bad_end = [x[-1] in " \t.,;:-_([{+" for x in atoms]
        for i, x in enumerate(atoms):
            if x in " \t\n\x0b\x0c\r.,;:-_)]}":
                continue
            for j in range(i + 1, min(i + MAX_ATOMS, len(atoms)) + 1):
                if atoms[j - 1] == "\n":
                    break
                n = digits[j] - digits[i]
                if ats[j] == ats[i]:
                    if n > 19:
                        break
                    if n < 9 and (n < 4 or dots[j] - dots[i] < 3):
                        continue
                if not bad_end[j - 1] and self.bounds[j] - self.bounds[i] >= 6:
                    self.pairs.append((i, j))

    def features(self, i: int, j: int) -> list[str]:
        text, x, y = self.text, self.bounds[i], self.bounds[j]
        return features(text[x:y], text[max(0, x - 24) : x], text[y : y + 1])

    def keys(self) -> Iterator[tuple[int, int, tuple]]:
        """(first, past, key) of every candidate; candidates with one key have the same features."""
        text, bounds, last, left, word = self.text, self.bounds, -1, "", ""
        for i, j in self.pairs:
            x, y = bounds[i], bounds[j]
            if i != last:
                before, last = text[max(0, x - 24) : x], i
                words = _LETTERS.findall(before)
                left, word = _kind(before[-1:]), words[-1].lower() if words else ""
            shape = "".join(self.shapes[i:j])
            span = text[x:y]
            numbers = _DIGITS.findall(span)
            n = sum(map(len, numbers))
            # what digits say beyond their number, and where they are told apart
            said = (luhn("".join(numbers)) if 12 <= n <= 19 else None, len(numbers) == 4 and all(_byte(p) for p in numbers))
            yield i, j, (shape, left, word, _kind(text[y : y + 1]), said)


class Field:
    """Weights by feature, one for each kind; the score of a stretch outside any segment is 0."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None) -> None:
        self.weights = weights or {}
        self.known: dict[tuple, tuple[float, int]] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "known": {}}

    def scores(self, found: list[str]) -> np.ndarray:
        total = np.zeros(len(KINDS))
        for f in found:
            w = self.weights.get(f)
            if w is not None:
                total += w
        return total

    def segments(self, text: str, a: int, b: int) -> tuple[list[int], list[tuple[int, int, list[str]]]]:
        """Atom bounds of ``text[a:b]`` and (first, past, features) of every candidate segment."""
        c = Candidates(text, a, b)
        return c.bounds, [(i, j, c.features(i, j)) for i, j in c.pairs]

    def best(self, text: str, a: int, b: int, margin: float = MARGIN) -> list[tuple[int, int, int]]:
        """The best segmentation of ``text[a:b]``: its segments with their kinds."""
        candidates = Candidates(text, a, b)
        bounds = candidates.bounds
        if len(self.known) > REMEMBERED:
            self.known.clear()
        into: dict[int, list[tuple[int, float, int]]] = {}
        for i, j, key in candidates.keys():
            held = self.known.get(key)
            if held is None:
                s = self.scores(candidates.features(i, j))
                held = self.known[key] = float(s.max()), int(s.argmax())
            if held[0] > margin:
                into.setdefault(j, []).append((i, held[0] - margin, held[1]))
        top, back = [0.0], [None]
        for j in range(1, len(bounds)):
            value, came = top[j - 1], None
            for i, s, k in into.get(j, ()):
                if top[i] + s > value:
                    value, came = top[i] + s, (i, k)
            top.append(value)
            back.append(came)
        out, j = [], len(bounds) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                out.append((bounds[i], bounds[j], k))
                j = i
        return out[::-1]


def fit(passages: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = ROUNDS, rate: float = 0.3, pull: float = 1e-3) -> Field:
    """Maximum likelihood over segmentations by adaptive gradient steps, a passage at a time."""
    field, grown = Field(), {}
    ready = []
    for text, spans in passages:
        bounds, candidates = field.segments(text, 0, len(text))
        place = {b: k for k, b in enumerate(bounds)}
        gold = {(place[a], place[b]): k for a, b, k in spans if a in place and b in place}
        ready.append((len(bounds), candidates, gold))
    for _ in range(rounds):
        for n, candidates, gold in ready:
            if not candidates:
                continue
            score = np.array([field.scores(f) for _, _, f in candidates])
            ahead, behind = _sums(n, candidates, score)
            gradient: dict[str, np.ndarray] = {}
            for (i, j, found), s in zip(candidates, score):
                g = -np.exp(np.clip(ahead[i] + s + behind[j] - ahead[-1], -50, 0))
                k = gold.get((i, j))
                if k is not None:
                    g[k] += 1
                if np.abs(g).max() > 1e-3:
                    for f in found:
                        gradient[f] = gradient[f] + g if f in gradient else g
            for f, g in gradient.items():
                w = field.weights.get(f)
                if w is None:
                    w, grown[f] = np.zeros(len(KINDS)), np.full(len(KINDS), 1e-2)
                g = g - pull * w
                grown[f] = grown[f] + g * g
                field.weights[f] = w + rate * g / np.sqrt(grown[f])
    return field


def _sums(n: int, candidates: list, score: np.ndarray) -> tuple[list[float], list[float]]:
    """Log sums over the segmentations before and after each bound."""
    total = np.logaddexp.reduce(score, axis=1)
    ends: dict[int, list] = {}
    starts: dict[int, list] = {}
    for (i, j, _), s in zip(candidates, total):
        ends.setdefault(j, []).append((i, s))
        starts.setdefault(i, []).append((j, s))
    ahead = [0.0] * n
    for j in range(1, n):
        ahead[j] = _log_sum([ahead[j - 1], *(ahead[i] + s for i, s in ends.get(j, ()))])
    behind = [0.0] * n
    for i in range(n - 2, -1, -1):
        behind[i] = _log_sum([behind[i + 1], *(behind[j] + s for j, s in starts.get(i, ()))])
    return ahead, behind


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


#: How "@" and "." of an address are written out.
ATS = (" at ", " AT ", " At ", "(at)", "(At)", " (at) ", "[at]", " [at] ", " @ ")
DOTS = (".", " dot ", " DOT ", " punkt ", " punto ", " point ", " (dot) ", "[dot]")


def _emails_whole(text: str) -> bool:
    return list(_emails(text)) == [(0, len(text))]


def vary(span: str, kind: int, rng: random.Random) -> str:
    """A span as people disguise or vary it."""
    if kind == 0:
        if rng.random() < 0.5:
            bare = re.sub("[0-9]+", "", span)
            span = bare if _emails_whole(bare) else span
        name, _, domain = span.partition("@")
        return name + rng.choice(ATS) + domain.replace(".", rng.choice(DOTS))
    digits = re.sub("[^0-9]", "", span)
    if kind == 1:
        return rng.choice(["[.]", " . ", "(.)", "[dot]", " dot "]).join(span.split("."))
    if kind == 2:
        mark = rng.choice([".", "/", "  ", " - ", "_"])
        return mark.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    own = digits[-10:]
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "00" + digits[:-10] + " {} {} {}", "{} {} {}", "{}/{}-{}"]).format(own[:-7], own[-7:-4], own[-4:])


def passages_of(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, limit: int = SAMPLE_PASSAGES) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """``limit`` passages at most of a sample of ``docs`` (doc_id, text) with digits, signs or words for them: those with the least hash, three quarters with base spans and one without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                rows = []
                for text in batch.column("text").to_pylist():
                    spans = base_spans(text or "")
                    for a, b in regions(text or "", []):
                        if b - a <= PASSAGE:
                            rows.append((text[a:b], [{"a": s - a, "b": e - a, "k": k} for s, e, k in spans if s >= a and e <= b]))
                if rows:
                    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("k", pa.int32())]))
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], kind)], ["passage", "spans"])

    some = docs.where("text is not null").select("doc_id", "text")
    n = some.count()
    if not n:
        return []
    share = min(1.0, sample_docs / n)
    some = some.where(drawn("doc_id", share)).select("text")
    found = map_batches(some, run, "passage string, spans array<struct<a:int,b:int,k:int>>").distinct()
    place = F.row_number().over(Window.partitionBy("bare").orderBy(F.xxhash64("passage"), "passage"))
    found = found.withColumn("bare", F.size("spans") == 0).withColumn("place", place).where(F.col("place") <= F.when(F.col("bare"), limit // 4).otherwise(limit - limit // 4))
    found = found.orderBy("bare", "place").collect()
    return [(r["passage"], [(s["a"], s["b"], s["k"]) for s in r["spans"]]) for r in found]


def learn(docs: DataFrame) -> Field:
    """A field trained on passages of ``docs`` (doc_id, text); without any, it finds nothing beyond the base spans."""
    rng, seen = random.Random(7), []
    for text, spans in passages_of(docs):
        flat = [s for k, s in enumerate(spans) if not k or s[0] >= spans[k - 1][1]]
        seen.append((text, flat))
        for _ in range(2):
            out, new, at = "", [], 0
            for a, b, k in flat:
                out += text[at:a]
                varied = vary(text[a:b], k, rng)
                new.append((len(out), len(out) + len(varied), k))
                out, at = out + varied, b
            if new:
                seen.append((out + text[at:], new))
    rng.shuffle(seen)
    return fit(seen)


def find_private(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base_spans and spans (kind, start, end), both by start, then kind.

    Places are code points, ends exclusive; ``spans`` holds the base spans and what the field adds
    outside them. A null or empty text has none. Texts of any length are read whole, in time
    linear in their length. Of segmentations with one score the one with fewer, later segments counts. Repeated rows have the same spans; no other
    column is read, and an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = given.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held.value
        rows_of = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans]
        for whole in batches:
            for batch in text_slices(whole):
                base, every = [], []
                for text in batch.column("text").to_pylist():
                    spans = base_spans(text or "")
                    base.append(rows_of(spans))
                    every.append(rows_of(sorted(spans + added(text or "", spans, field), key=lambda s: (s[0], s[2]))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base_spans", "spans"])

    id_kind = given.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,start:int,end:int>>"
    return map_batches(given, run, f"doc_id {id_kind}, base_spans {span}, spans {span}")


def added(text: str, taken: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """What the field finds in ``text`` outside the spans taken."""
    if not field.weights:
        return []
    return [s for c, d in _gaps(regions(text, taken), taken) for s in field.best(text, c, d)]


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its first kind in capitals and brackets."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with all personal data in ``text_col`` replaced; all other columns and all rows stay, a null text stays null."""
    held = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held.value
        for whole in batches:
            for batch in text_slices(whole, text_col):
                at = batch.schema.get_field_index(text_col)
                out = []
                for text in batch.column(at).to_pylist():
                    spans = base_spans(text or "")
                    spans = sorted(spans + added(text or "", spans, field), key=lambda s: (s[0], s[2]))
                    out.append(redacted(text, spans) if spans else text)
                yield batch.set_column(at, text_col, pa.array(out, pa.string()))

    return map_batches(docs, run, docs.schema)
