"""Personal data in texts: fixed patterns, and a linear-chain conditional random field for what they leave out.

The patterns give the base spans, which always stay. The field adds spans of the same kinds in other writing: telephone
numbers without a plus, card numbers with other separators, addresses spelled out. It labels tokens (runs of letters, runs
of digits, single other characters) as outside, or as the beginning or inside of a kind, from the shapes of words and of
the number runs they are in. Its weights are learned from a small labelled table (``labelled``) by full likelihood, and
decoding is Viterbi over many token chains at once, a numpy step for each place in the chain.

Tokens far from any number run that is long enough, and from any written-out "at", can only be outside. A chain is thus
cut there without changing its best labelling, and only the pieces between such tokens are decoded.

Texts are read where they lie; there is no shuffle, and a task holds a slice of texts.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import map_columns

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits: where the run's first digit fails, so do the others
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    """Whether the digits' check sum is right."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def is_card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern, in time linear in the text: from each @, the local part is read backwards, the domain forwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by start and kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and is_card(digits_of(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


# the tokens of a text that may be more than outside

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
NUMBERS = re.compile(r"[0-9]+(?:[\s.\-/()_\[\]{}]{1,5}[0-9]+)*")
AT = re.compile(r"@|[\[({<]\s?(?:at|arroba)\s?[\])}>]|\b(?:at|arroba)\s+\S{1,64}\s*[\[({<]?\s?(?:dot|punto|punkt|point)\b", re.IGNORECASE)
CUES = {
    "AT": "at arroba",
    "DOT": "dot punto punkt point",
    "PHONE": "tel phone call telephone mobile fax cell telefon téléphone teléfono ring dial whatsapp",
    "CARD": "card visa mastercard amex karte carte tarjeta credit debit",
    "IP": "ip host server address gateway ping subnet",
    "MAIL": "email mail contact write correo",
    "TLD": "com org net edu io info example de fr es",
    "OTHER": "isbn order invoice no nr ref version v page pp section id serial sn sku room part item case total date code batch",
}
CUE = {word: name for name, words in CUES.items() for word in words.split()}
BEFORE, AFTER = 8, 8


def regions(text: str) -> list[tuple[int, int]]:
    """The parts of a text around written-out addresses and number runs of seven digits or four groups, and more."""
    marks = [m.span() for m in NUMBERS.finditer(text) if m.end() - m.start() >= 7 and (len(digits_of(m[0])) >= 7 or len(re.findall("[0-9]+", m[0])) >= 4)]
    marks += [m.span() for m in AT.finditer(text)]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(marks):  # between marks so close lie no more tokens than are taken along
        if joined and a <= joined[-1][1] + AFTER:
            joined[-1] = joined[-1][0], max(b, joined[-1][1])
        else:
            joined.append((a, b))
    out: list[tuple[int, int]] = []
    for a, b in joined:
        before = [m.start() for m in TOKEN.finditer(text, max(0, a - 96), a)][-BEFORE:]
        after = [m.end() for m in TOKEN.finditer(text, b, b + 96)][:AFTER]
        lo, hi = min(before, default=a), max(after, default=b)
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def shape(token: str) -> str:
    """Letters by case and length, digits by length, other characters as they are."""
    n = len(token)
    if token[0].isdigit():
        return f"d{n}" if n <= 8 else "d9" if n <= 13 else "d14" if n <= 19 else "d20"
    if token[0].isalpha():
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return f"{case}{min(n, 4)}"
    return token


def number_runs(text: str, tokens: list[tuple[int, int]]) -> list[str]:
    """For each token what the number run around it looks like: digits, check sum, groups, separators; empty outside runs."""
    out, k = [""] * len(tokens), 0
    numeric = [text[a] in "0123456789" for a, _ in tokens]
    while k < len(tokens):
        if not numeric[k]:
            k += 1
            continue
        groups, last = [k], k
        while (after := next((j for j in range(last + 1, min(last + 7, len(tokens))) if numeric[j]), None)) is not None and re.fullmatch(r"[\s.\-/()_\[\]{}]{1,5}", text[tokens[last][1] : tokens[after][0]]):
            groups.append(after)
            last = after
        parts = [text[slice(*tokens[j])] for j in groups]
        total = sum(map(len, parts))
        size = "few" if total < 7 else "seven" if total < 10 else "ten" if total < 12 else "twelve" if total < 14 else "card" if total < 20 else "many"
        check = "valid" if 14 <= total <= 19 and luhn("".join(parts)) else ""
        lengths = "-".join(str(len(x)) for x in parts) if len(parts) <= 5 else "more"
        octets = "octets" if len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts) else ""
        breaks = {re.sub(r"\s+", " ", text[tokens[a][1] : tokens[b][0]]) for a, b in zip(groups, groups[1:])}
        told = f"{size}{check}|{octets}|{lengths}|{'~'.join(sorted(breaks)) if len(breaks) <= 2 else 'mixed'}"
        for j in range(groups[0], last + 1):
            out[j] = told
        k = last + 1
    return out


SLOTS = 18


def described(text: str, tokens: list[tuple[int, int]]) -> Iterator[list[str]]:
    """The features of each token, one in each slot."""
    words = [text[a:b] for a, b in tokens]
    n = len(words)
    shapes = ["^", "^", *map(shape, words), "$", "$"]
    cues = ["", *(CUE.get(w.lower(), "AT" if w == "@" else "") for w in words), ""]
    gaps = [""] * (n + 1)
    for k in range(1, n):
        between = text[tokens[k - 1][1] : tokens[k][0]]
        gaps[k] = "" if not between else "n" if "\n" in between else "_" if len(between) == 1 else "="
    runs = number_runs(text, tokens)
    ats = [k for k in range(n) if cues[k + 1] == "AT"]
    near_at = {k: f"{d}" for at in ats for d in range(-6, 9) if 0 <= (k := at + d) < n}
    for k in range(n):
        here, run = shapes[k + 2], runs[k]
        size, _, groups = run.partition("|")
        place = ("first" if run and (k == 0 or runs[k - 1] != run) else "") + ("last" if run and (k + 1 == n or runs[k + 1] != run) else "")
        lately = next((c for c in reversed(cues[max(0, k - 5) + 1 : k + 1]) if c not in ("", "TLD")), "")
        at = near_at.get(k, "")
        dots = any(c == "DOT" or w == "." for c, w in zip(cues[k + 1 : k + 8], words[k : k + 7]))
        yield [
            "bias", f"s{here}", f"c{cues[k + 1]}", f"g{gaps[k]}|{gaps[k + 1]}", f"p{shapes[k + 1]}{gaps[k]}", f"n{gaps[k + 1]}{shapes[k + 3]}",
            f"P{shapes[k]}{shapes[k + 1]}", f"N{shapes[k + 3]}{shapes[k + 4]}", f"q{cues[k]}", f"m{cues[k + 2]}", f"r{size}|{place}", f"R{groups}|{place}",
            f"l{lately}|{size}", f"t{shapes[k + 1]}{gaps[k]}{here}{gaps[k + 1]}{shapes[k + 3]}", f"a{at}", f"A{at}|{here[:1]}|{dots}", f"b{run}|{place}", f"L{lately}|{here}",
        ]


# the field

LABELS = 1 + 2 * len(KINDS)  # outside, then beginning and inside of each kind
NEVER = -1e4


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """(start, step): 0 where a label may begin a chain or follow another, else NEVER. Inside follows its own kind only."""
    start, step = np.zeros(LABELS), np.zeros((LABELS, LABELS))
    for kind in range(len(KINDS)):
        begin, inside = 1 + 2 * kind, 2 + 2 * kind
        start[inside] = NEVER
        step[:, inside] = NEVER
        step[[begin, inside], inside] = 0
    return start, step


@dataclass(frozen=True)
class Field:
    """Weights of features (row 0: of unknown ones) and of steps between labels. Its size is that of its training table."""

    names: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def ids(self, features: Iterable[list[str]]) -> np.ndarray:
        return np.fromiter((self.names.get(f, 0) for own in features for f in own), np.int32).reshape(-1, SLOTS)

    def scores(self, features: Iterable[list[str]]) -> np.ndarray:
        """A row per token, a column per label."""
        ids = self.ids(features)
        return sum(self.weights[ids[:, k]] for k in range(SLOTS))


def viterbi(emissions: list[np.ndarray], start: np.ndarray, step: np.ndarray) -> list[np.ndarray]:
    """The best labelling of each chain. Chains of similar length go through together; ties go to the lower label."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(emissions)
    order = sorted((k for k in range(len(emissions)) if len(emissions[k])), key=lambda k: len(emissions[k]))
    while order:
        longest = len(emissions[order[-1]])
        many = max(1, 200_000 // longest)
        batch = [k for k in order[-many:] if 2 * len(emissions[k]) >= longest]
        order = order[: len(order) - len(batch)]
        lengths = np.array([len(emissions[k]) for k in batch])
        scores = np.zeros((len(batch), longest, LABELS))
        for row, k in enumerate(batch):
            scores[row, : lengths[row]] = emissions[k]
        best, back = scores[:, 0] + start, np.zeros((longest, len(batch), LABELS), np.int8)
        for t in range(1, longest):
            via = best[:, :, None] + step
            back[t] = via.argmax(1)
            grown = via.max(1) + scores[:, t]
            best = np.where((t < lengths)[:, None], grown, best)
        label, path = best.argmax(1), np.zeros((longest, len(batch)), np.int8)
        for t in range(longest - 1, -1, -1):
            path[t] = np.where(t < lengths, label, 0)
            if t:
                label = np.where(t < lengths, back[t, np.arange(len(batch)), label], label)
        for row, k in enumerate(batch):
            out[k] = path[: lengths[row], row]
    return out


def likelihood(scores: np.ndarray, gold: np.ndarray, mask: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Of padded chains (chain, place, label): the negative log likelihood of the gold labels, its gradient by score, and by step."""
    n, longest, _ = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    total = lambda x, axis: (top := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis))
    forward[:, 0] = scores[:, 0] + start
    for t in range(1, longest):
        grown = total(forward[:, t - 1, :, None] + step, 1) + scores[:, t]
        forward[:, t] = np.where(mask[:, t, None], grown, forward[:, t - 1])
    whole = total(forward[:, -1], 1)
    by_step = np.zeros_like(step)
    for t in range(longest - 1, 0, -1):
        later = (scores[:, t] + backward[:, t])[:, None, :] + step
        backward[:, t - 1] = np.where(mask[:, t, None], total(later, 2), backward[:, t])
        by_step += (np.exp(forward[:, t - 1, :, None] + later - whole[:, None, None]) * mask[:, t, None, None]).sum(0)
    by_score = np.exp(forward + backward - whole[:, None, None]) * mask[:, :, None]
    own = np.take_along_axis(scores, gold[:, :, None], 2).squeeze(2) * mask
    pairs = mask[:, 1:]
    reached = own.sum() + start[gold[:, 0]].sum() + (step[gold[:, :-1], gold[:, 1:]] * pairs).sum()
    np.add.at(by_score, (np.arange(n)[:, None], np.arange(longest), gold), -mask.astype(float))
    np.add.at(by_step, (gold[:, :-1][pairs], gold[:, 1:][pairs]), -1.0)
    return float(whole.sum() - reached), by_score, by_step


def gold_labels(tokens: list[tuple[int, int]], spans: Iterable[Span]) -> list[int]:
    out = [0] * len(tokens)
    for start, kind, end in spans:
        for k, (a, b) in enumerate(tokens):
            if start <= a and b <= end:
                out[k] = 1 + 2 * kind if a == start else 2 + 2 * kind
    return out


def train(table: list[tuple[str, list[Span]]], rounds: int = 100, decay: float = 0.02) -> Field:
    """A field learned from labelled texts, on the driver: the table is small and given. Adaptive gradient steps (Adam) on the
    likelihood of whole chains with a quadratic penalty."""
    chains, names = [], {}
    for text, spans in table:
        for lo, hi in regions(text):
            tokens = [m.span() for m in TOKEN.finditer(text, lo, hi)]
            features = list(described(text, tokens))
            for own in features:
                for f in own:
                    names.setdefault(f, len(names) + 1)
            chains.append((features, gold_labels(tokens, spans)))
    field = Field(names, np.zeros((len(names) + 1, LABELS)), np.zeros((LABELS, LABELS)))
    longest = max(len(y) for _, y in chains)
    ids, gold, mask = np.zeros((len(chains), longest, SLOTS), np.int32), np.zeros((len(chains), longest), np.int64), np.zeros((len(chains), longest), bool)
    for k, (features, y) in enumerate(chains):
        ids[k, : len(y)], gold[k, : len(y)], mask[k, : len(y)] = field.ids(features), y, True
    start, fixed = allowed()
    flat = ids.reshape(-1)
    params = [field.weights, field.steps]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        scores = params[0][ids].sum(2)
        _, by_score, by_step = likelihood(scores, gold, mask, start, fixed + params[1])
        own = by_score.reshape(-1, LABELS)
        by_weight = np.stack([np.bincount(flat, np.repeat(own[:, k], SLOTS), len(names) + 1) for k in range(LABELS)], 1)
        by_weight[0] = 0
        for k, gradient in enumerate((by_weight, by_step)):
            gradient = gradient + decay * params[k]
            first[k] = 0.9 * first[k] + 0.1 * gradient
            second[k] = 0.999 * second[k] + 0.001 * gradient**2
            params[k] -= 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return field


def decoded(texts: list[str], field: Field) -> list[list[Span]]:
    """The spans that the field sees in each text."""
    start, fixed = allowed()
    step, out = fixed + field.steps, [[] for _ in texts]
    pieces, emissions = [], []
    for k, text in enumerate(texts):
        for lo, hi in regions(text):
            tokens = [m.span() for m in TOKEN.finditer(text, lo, hi)]
            pieces.append((k, tokens))
            emissions.append(field.scores(described(text, tokens)))
    for (k, tokens), labels in zip(pieces, viterbi(emissions, start, step)):
        for place in np.flatnonzero(labels % 2 == 1).tolist():
            end = place + 1
            while end < len(labels) and labels[end] == labels[place] + 1:
                end += 1
            out[k].append((tokens[place][0], (int(labels[place]) - 1) // 2, tokens[end - 1][1]))
    return out


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text. What the field sees that meets a base span is that one, and is not added."""
    out = []
    for text, seen in zip(texts, decoded(texts, field)):
        base, added = base_spans(text), []
        starts = [a for a, _, _ in base]
        reach = list(accumulate((b for _, _, b in base), max))  # how far the spans up to each one go
        for start, kind, end in seen:
            before = bisect_left(starts, end)
            if not before or reach[before - 1] <= start:
                added.append((start, kind, end))
        out.append((base, added))
    return out


# the labelled table: sentences with the parts that are personal data in braces, built by rule from these fixed values

SENTENCES = {
    "phone": ("Call {} before noon.", "Tel: {}", "my phone is {}, ask for Ann", "Fax {} or write", "Reach the office at {} today", "telefon {} bitte", "mobile {}", "Ring {} and wait", "or dial {}; thanks", "numbers: {} and {}"),
    "card": ("Pay with card {} now", "visa {} exp 04/27", "the number {} was charged", "Karte {} gesperrt", "{} is my credit card", "debit {}"),
    "ip": ("the host {} is down", "blocked {} again", "ping {} twice", "Server {} answered", "seen from {} and {}"),
    "email": ("write to {} please", "contact {} for more", "mail: {}", "send it to {}, thanks", "{} is where I am", "Email {} or call"),
    "none": ("It was {} then.", "the total is {} in all", "order {} has left", "see {} and so on", "version {} is out", "Ref {} in the file", "a value of {} and {}", "From {} to the end", "{}", "code {} in part {}", "page {} of it", "ISBN {}"),
}
SHAPES = {
    "phone": ("(###) ###-####", "###-###-####", "###.###.####", "1-###-###-####", "0## #### ####", "00## ## #######", "0##/#######", "(0##) ######", "###-####", "+1 (###) ###-####", "+## ### ######"),
    "card": ("####.####.####.####", "####/####/####/####", "####  ####  ####  ####", "####_####_####_####", "#### #### #### ####", "####-####-####-####", "################", "#### ###### #####", "####.######.#####"),
    "ip": ("%[.]%[.]%[.]%", "%(.)%(.)%(.)%", "% . % . % . %", "%.%.%.%", "%[.]%.%[.]%"),
    "email": ("~ [at] ~ [dot] ^", "~(at)~.^", "~ at ~ dot ^", "~ AT ~ DOT ^", "~.~ [at] ~.^", "~_~ (at) ~ (dot) ^", "~ @ ~.^", "~@~.^", "~# at ~ dot ^", "~.~ at ~ dot ~ dot ^", "~ {at} ~.^"),
    "none": ("20##-0#-1#", "1#/0#/20##", "1#.0#.20##", "1#:4#:3#", "$#,###.##", "#.#.#", "978-#-##-######-#", "################", "####-####-####-####", "#### #### #### ####", "##.####, #.####", "199#-200#", "#####-####", "###-###", "##########", "#######", "########", "#########", "20###### ######", "### ### ###", "# # # # # #", "## ## ## ## ##", "########-####-####", "0x########", "####.####.####.####", "###,###,###", "1#.0#.20## 1#:3#", "20##-0#-1#T1#:4#:3#Z", "#.#.#.#.#", "~ at ~ on 20##-0#-1#", "## | ## | ## | ##", "##, ##, ##, ##", "~### ### ~## ##"),
}
FILL = "Mira lunar Otto stone field kappa Jonas river brook delta amber Nadia north quill basil Tara".split()
ENDS = "com org net edu io example".split()


def filled(pattern: str, kind: str, rng: random.Random) -> str:
    """A pattern with digits for #, octets for %, words for ~ and endings for ^. The last digit of a card makes its sum right,
    that of a number which is none makes it wrong."""
    word = rng.choice if kind == "none" else lambda words: rng.choice(words).lower()
    make = {"#": lambda: str(rng.randrange(10)), "%": lambda: str(rng.randrange(256)), "~": lambda: word(FILL), "^": lambda: rng.choice(ENDS)}
    out = "".join(make[c]() if c in make else c for c in pattern)
    if kind == "card" or kind == "none" and 14 <= len(digits_of(out)) <= 19:
        at = max(k for k, c in enumerate(out) if c.isdigit())
        out = next(x for d in range(10) if luhn(digits_of(x := f"{out[:at]}{d}{out[at + 1 :]}")) == (kind == "card"))
    return out


def labelled(copies: int = 4, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """(text, spans): every pattern in ``copies`` of its kind's sentences, amid other words."""
    rng, out = random.Random(seed), []
    for kind, patterns in SHAPES.items():
        for pattern in patterns:
            for _ in range(copies):
                lead = " ".join(rng.choice(FILL) for _ in range(rng.randrange(4)))
                text, spans = lead + " " * bool(lead), []
                for k, piece in enumerate(rng.choice(SENTENCES[kind]).split("{}")):
                    if k:
                        value = filled(pattern, kind, rng)
                        if kind != "none":
                            spans.append((len(text), KINDS.index(kind), len(text) + len(value)))
                        text += value
                    text += piece
                out.append((text + " " + " ".join(rng.choice(FILL) for _ in range(rng.randrange(4))), spans))
    return out


@cache
def default_field() -> Field:
    return train(labelled())


FOUND = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None, redact: bool = False) -> DataFrame:
    """key, spans (kind, start, end by code points, end exclusive, base; by start, then kind), and with ``redact`` the text with
    every span's place taken by its kind in brackets.

    A row per row of ``docs``, whatever its key; a null text is an empty one. Spans of different kinds may meet, of which
    redacting leaves the first kind's name. Other columns of ``docs`` are not read.
    """
    field = field or default_field()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in batch["text"].to_pylist()]
        found = [sorted([(*x, True) for x in base] + [(*x, False) for x in more]) for base, more in all_spans(texts, field)]
        out = {"key": batch["key"], "spans": pa.array([[{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in each] for each in found], kind)}
        if redact:
            out["redacted"] = pa.array([redacted(t, [(a, k, b) for a, k, b, _ in each]) for t, each in zip(texts, found)], pa.string())
        return pa.record_batch(out)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = map_columns(rows, run, f"key {dict(rows.dtypes)['key']}, spans {FOUND}" + (", redacted string" if redact else ""))
    return out.withColumnRenamed("key", key)


def redacted(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind]}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, the base spans' counts by kind and their digest, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(key, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
