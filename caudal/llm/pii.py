"""Personal data: four patterns, and a linear-chain conditional random field for what they miss.

1. Base. E-mail addresses, IP addresses, card and phone numbers by pattern, leftmost and without overlap for each kind, checked
   (numbers up to 255, Luhn, number of digits). A match that fails the check is dropped and not tried again in parts.
2. Sequences. Tokens are runs of digits, runs of letters and single other characters. The field reads the surroundings (`MARGIN`
   characters, out to white space) of every digit, at sign and bracketed "at"; nothing else can pass the checks.
3. Field. Tags are outside, and first or further token of a kind. Features are word shapes (kind of token, length, case, white
   space before) of a token and its neighbours alone and together, the digits of the number it stands in, and the words before.
   Weights are fitted to a small labelled table by gradient ascent on the conditional likelihood (forward and backward sums).
4. Decoding. Viterbi over all sequences of a batch of texts together, in numpy, sequences of like length side by side.
5. Checks. A span of the field is added if what it spells is of its kind (Luhn and so on; an at sign may be written out) and it
   touches no base span. Base spans stay as they are.

Defined results: a NULL text is the empty one and has no spans. NULL and repeated doc_ids are ids like others, repeated rows are
rows each. Texts are read whole; offsets are code points, ends exclusive. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.common import PIECE, chunks, mapped

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
MARGIN = 48
MAX_LABELLED = 5_000
Span = tuple[int, int, int]  # start, kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a try inside a run of digits would end like that at the run's beginning: none is made, so long runs take linear time
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by start and then by kind."""
    spans = [(s, 0, e) for s, e in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m[0])]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m[0])]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(spans)


SPELLED_AT, SPELLED_DOT = (re.compile(rf"\s*[\[(]\s*{w}\s*[\])]\s*", re.IGNORECASE) for w in ("(?:at|@)", r"(?:dot|\.)"))
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBER_OF = {1: re.compile(r"[0-9]+(?:\s?\.\s?[0-9]+){3}"), 2: re.compile(r"[0-9](?:[\s.-]{0,3}[0-9])+"), 3: re.compile(r"(?:\+|\()?\s?[0-9](?:[\s()./-]{0,3}[0-9])+")}


def is_of_kind(kind: int, text: str) -> bool:
    """Whether a span that the field proposes spells something of its kind."""
    if kind == 0:
        return EMAIL.fullmatch(SPELLED_DOT.sub(".", SPELLED_AT.sub("@", text)).replace(" @ ", "@")) is not None
    if not NUMBER_OF[kind].fullmatch(text):
        return False
    if kind == 1:
        return is_ip(re.sub(r"\s", "", text))
    if kind == 2:
        return is_card(text)
    return 7 <= len(NOT_DIGIT.sub("", text)) <= 15 and not text.isdigit()


# ---- the field

TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
ANCHOR = re.compile(r"[0-9@]+|[\[(]\s?at\s?[\])]", re.IGNORECASE)
PAD = 0


@functools.lru_cache(maxsize=200_000)
def shape(token: str) -> tuple[int, int]:
    """A token's shape (under 128) and its word (0 if it is none)."""
    if "0" <= token[0] <= "9":
        n = min(len(token), 20)
        marked = int(token) <= 255 if n <= 3 else 14 <= len(token) <= 19 and luhn(token)
        return 1 + n + (22 if marked else 0), 0
    if token[0].isalpha():
        case = 0 if token.islower() else 1 if token.isupper() else 2 if token.istitle() else 3
        return 48 + 4 * case + min(len(token), 4) - 1, 1 + zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
    return (64 + ord(token) % 64 if ord(token) < 128 else 47), 0


@dataclass(frozen=True, eq=False)
class Sequences:
    """Tokens of sequences one after the other: their starts and ends in the text, shape (white space before it included), word,
    digits of the number around it, and where each sequence begins (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    word: np.ndarray
    digits: np.ndarray
    begins: np.ndarray


def windows(text: str) -> Iterator[tuple[int, int]]:
    """The surroundings of all anchors, joined where they meet."""
    start = stop = -1
    for m in ANCHOR.finditer(text):
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if start < 0 or low > stop:
            if start >= 0:
                yield start, stop
            start = low
            while 0 < start and low - start < MARGIN and not text[start - 1].isspace():
                start -= 1
            start = max(start, stop)
        stop = high
        while stop < len(text) and stop - high < MARGIN and not text[stop].isspace():
            stop += 1
    if start >= 0:
        yield start, stop


NUMBER_PARTS = frozenset("()+./-")


def sequences(texts: Sequence[str], cuts: Sequence[Sequence[tuple[int, int]]]) -> Sequences:
    starts, ends, shapes, words, digits, begins = [], [], [], [], [], [0]
    for text, own in zip(texts, cuts):
        for low, high in own:
            last, run, number = low, 0, len(starts)
            for m in TOKEN.finditer(text, low, high):
                token, start = m[0], m.start()
                kind, word = shape(token)
                gap = 0 if start == last else 1 if text[last:start].strip(" ") == "" else 2
                if "0" <= token[0] <= "9":
                    run += len(token)
                elif token not in NUMBER_PARTS:
                    digits += [run] * (len(starts) - number) + [0]
                    number, run = len(starts) + 1, 0
                last = m.end()
                starts.append(start)
                ends.append(last)
                shapes.append(3 * kind + gap)
                words.append(word)
            digits += [run] * (len(starts) - number)
            begins.append(len(starts))
    as_array = functools.partial(np.array, dtype=np.int64)
    return Sequences(as_array(starts), as_array(ends), as_array(shapes), as_array(words), np.minimum(as_array(digits), 24), as_array(begins))


SHAPES = 3 * 128


def features(s: Sequences) -> list[tuple[int, np.ndarray]]:
    """Number of the template and the feature of each token. Beyond a sequence stands padding."""
    own = np.repeat(np.arange(len(s.begins) - 1), np.diff(s.begins))

    def moved(values: np.ndarray, by: int) -> np.ndarray:
        out = np.full(len(values), PAD, dtype=np.int64)
        if by < 0:
            out[-by:] = np.where(own[:by] == own[-by:], values[:by], PAD)
        else:
            out[:-by] = np.where(own[by:] == own[:-by], values[by:], PAD)
        return out

    at = {0: s.shape, **{k: moved(s.shape, k) for k in (-2, -1, 1, 2)}}
    both = lambda *ks: functools.reduce(lambda a, k: a * SHAPES + at[k], ks, 0)
    combined = [(0,), (-1,), (1,), (-2,), (2,), (-1, 0), (0, 1), (-1, 0, 1), (-2, -1, 0), (0, 1, 2)]
    found = [(i, both(*ks)) for i, ks in enumerate(combined)]
    found += [(10, s.word), (11, 25 * s.shape + s.digits)]
    return found + [(12, moved(s.word, -k)) for k in (1, 2, 3, 4)]


@dataclass(frozen=True, eq=False)
class Field:
    """known: for each template its features, ascending; weights: a row of tags for each, the last one 0; moves: from tag to tag."""

    known: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]
    moves: np.ndarray

    def rows(self, s: Sequences) -> list[tuple[int, np.ndarray]]:
        out = []
        for template, values in features(s):
            known = self.known[template]
            place = np.searchsorted(known, values)
            found = known[np.minimum(place, len(known) - 1)] == values
            out.append((template, np.where(found, place, len(known))))
        return out

    def scores(self, s: Sequences) -> np.ndarray:
        return sum(self.weights[t][rows] for t, rows in self.rows(s))


FORBIDDEN = -1e4


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else FORBIDDEN: a kind goes on only after it has begun. The last row is a beginning."""
    moves = np.zeros((len(TAGS) + 1, len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            moves[[i for i in range(len(TAGS) + 1) if i not in (j - 1, j)], j] = FORBIDDEN
    return moves


def batches(begins: np.ndarray, tokens: int = 200_000) -> Iterator[tuple[np.ndarray, int]]:
    """Sequences of like length (their numbers, and the longest's length), about so many tokens together, padding included."""
    lengths = np.diff(begins)
    order = np.argsort(lengths, kind="stable")[::-1]
    order = order[lengths[order] > 0]
    i = 0
    while i < len(order):
        longest = int(lengths[order[i]])
        few = order[i : i + max(1, tokens // longest)]
        few = few[lengths[few] * 2 >= longest]
        yield few, longest
        i += len(few)


def viterbi(scores: np.ndarray, begins: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tag of each token."""
    tags = np.zeros(len(scores), dtype=np.int8)
    step = moves[:-1]
    for few, longest in batches(begins):
        first, length = begins[few], np.diff(begins)[few]
        best = scores[first] + moves[-1]
        back = np.zeros((longest, len(few), len(TAGS)), dtype=np.int8)
        final = np.where((length == 1)[:, None], best, 0.0)
        for t in range(1, longest):
            live = int(np.searchsorted(-length, -t, side="left"))  # lengths descend
            joined = best[:live, :, None] + step
            back[t, :live] = joined.argmax(1)
            best = joined.max(1) + scores[first[:live] + t]
            ended = length[:live] == t + 1
            final[:live][ended] = best[ended]
        tag = final.argmax(1).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, side="left"))
            tags[first[:live] + t] = tag[:live]
            tag[:live] = np.where(length[:live] > t, back[t, np.arange(live), tag[:live]], tag[:live])
    return tags


def proposed(texts: Sequence[str], field: Field) -> Iterator[list[Span]]:
    """The spans of the field for each text, unchecked."""
    cuts = [list(windows(t)) for t in texts]
    s = sequences(texts, cuts)
    tags = viterbi(field.scores(s), s.begins, field.moves) if len(s.start) else np.zeros(0, dtype=np.int8)
    n = 0
    for own in cuts:
        spans = []
        for _ in own:
            low, high = s.begins[n], s.begins[n + 1]
            n += 1
            for i in np.flatnonzero(tags[low:high] % 2 == 1) + low:  # odd tags begin a kind
                j = i + 1
                while j < high and tags[j] == tags[i] + 1:
                    j += 1
                spans.append((int(s.start[i]), int(tags[i]) // 2, int(s.end[j - 1])))
        yield spans


def added_spans(text: str, base: list[Span], spans: list[Span]) -> list[Span]:
    """What the field adds: of its kind, and apart from the base."""
    return [(a, k, b) for a, k, b in spans if is_of_kind(k, text[a:b]) and not any(a < y and x < b for x, _, y in base)]


# ---- training

MARKED = re.compile(r"\{(email|ip|card|phone):([^{}]*)\}")


def parse_marked(marked: str) -> tuple[str, list[Span]]:
    """A text with its spans written {kind:…} to the text and the spans."""
    text, spans, last = "", [], 0
    for m in MARKED.finditer(marked):
        text += marked[last : m.start()]
        spans.append((len(text), KINDS.index(m[1]), len(text) + len(m[2])))
        text += m[2]
        last = m.end()
    return text + marked[last:], spans


def _tags(s: Sequences, cuts: list[list[tuple[int, int]]], spans: list[list[Span]]) -> np.ndarray:
    tags, n = np.zeros(len(s.start), dtype=np.int64), 0
    for own, marked in zip(cuts, spans):
        for _ in own:
            for i in range(s.begins[n], s.begins[n + 1]):
                for a, k, b in marked:
                    if a <= s.start[i] and s.end[i] <= b:
                        tags[i] = 1 + 2 * k + (s.start[i] > a)
            n += 1
    return tags


def _expected(scores: np.ndarray, begins: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of each tag at each token, expected moves, and the sum of the log partition functions."""

    def logsum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis)
        return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))

    marginal, moved, total = np.zeros_like(scores), np.zeros_like(moves), 0.0
    step = moves[:-1]
    for few, longest in batches(begins):
        for q in few:  # few and short: the labelled table
            x = scores[begins[q] : begins[q + 1]]
            ahead, behind = np.zeros_like(x), np.zeros_like(x)
            ahead[0] = x[0] + moves[-1]
            for t in range(1, len(x)):
                ahead[t] = logsum(ahead[t - 1][:, None] + step, 0) + x[t]
            for t in range(len(x) - 2, -1, -1):
                behind[t] = logsum(step + x[t + 1] + behind[t + 1], 1)
            z = float(logsum(ahead[-1], 0))
            marginal[begins[q] : begins[q + 1]] = np.exp(ahead + behind - z)
            moved[-1] += marginal[begins[q]]
            if len(x) > 1:
                moved[:-1] += np.exp(ahead[:-1, :, None] + step + (x[1:] + behind[1:])[:, None, :] - z).sum(0)
            total += z
    return marginal, moved, total


def train(labelled: DataFrame, rounds: int = 60, ridge: float = 0.02, rate: float = 0.2, max_labelled: int = MAX_LABELLED) -> Field:
    """labelled: a column `marked`, texts with their spans as {kind:…}. At most max_labelled rows; the driver fits the field."""
    rows = sorted(r.marked for r in labelled.select("marked").limit(max_labelled + 1).collect() if r.marked)
    if len(rows) > max_labelled:
        raise ValueError(f"more than {max_labelled} labelled rows")
    texts, spans = zip(*map(parse_marked, rows)) if rows else ((), ())
    cuts = [list(windows(t)) for t in texts]
    s = sequences(texts, cuts)
    tags = _tags(s, cuts, spans)
    by: dict[int, list[np.ndarray]] = {}
    for template, values in features(s):
        by.setdefault(template, []).append(values)
    known = tuple(np.unique(np.concatenate([[-1], *by[t]])) for t in sorted(by))  # -1: no feature
    field = Field(known, tuple(np.zeros((len(k) + 1, len(TAGS))) for k in known), _allowed())
    if not len(s.start):
        return field
    index = field.rows(s)
    free = field.moves > FORBIDDEN / 2
    seen_moves = np.zeros_like(field.moves)
    before = np.concatenate(([len(TAGS)], tags[:-1]))
    before[s.begins[:-1][np.diff(s.begins) > 0]] = len(TAGS)
    np.add.at(seen_moves, (before, tags), 1)
    truth = np.eye(len(TAGS))[tags]
    squares = [np.full_like(w, 1e-6) for w in (*field.weights, field.moves)]
    for _ in range(rounds):
        marginal, moved, _ = _expected(field.scores(s), s.begins, field.moves)
        slopes = [-ridge * w for w in field.weights]
        for template, rows_of in index:
            np.add.at(slopes[template], rows_of, truth - marginal)
        slopes.append(np.where(free, seen_moves - moved - ridge * field.moves, 0.0))
        for w, slope, square in zip((*field.weights, field.moves), slopes, squares):
            square += slope**2
            w += rate * slope / np.sqrt(square)
    for w in field.weights:
        w[-1] = 0.0
    return field


# The small labelled table: whole lines, spans marked. Numbers are invented; hosts are reserved names.
LABELLED = """
Write to {email:jane.roe@web.example.org} before Friday.
Contact: {email:j_doe77@mail.example.com}, room 12.
Mail an {email:info@verein.example.net} oder {email:kontakt+neu@haus.example.de} bitte.
Reach me under jane {email:roe (at) web.example.org} or by post.
Please use {email:sales [at] shop.example.com} for orders over 100 pieces.
You can ask {email:paul.k [at] lab (dot) example (dot) org} about the 3 samples.
mi correo es {email:ana.perez (at) casa.example.es} y vivo en el 4
écrivez à {email:luc [at] bureau.example.fr} avant 18 heures
the address {email:bob @ post.example.com} still works in 2024
Meet @ 5 pm near gate 7, says @anna_k on day 2.
Follow @news24 and @sport_1 for the 10 best goals.
Price @ 3.50 each, 12 @ 40.00 in all.
The host {ip:10.20.30.40} did not answer after 3 tries.
from {ip:192.0.2.17} port 22 ssh2
Server {ip:198.51.100.7}:8080 is up since 12:30.
ping {ip:203.0.113.250}, then {ip:203.0.113.251}, each 4 times
adresse IP {ip:172 . 16 . 0 . 9} du serveur
IP: {ip:8 . 8 . 4 . 4} antwortet in 20 ms
Version 3.10.2 replaces 3.9.18 and 2.7.
See section 4.2.1 and table 7.3 on page 112.
Release 12.4.300.1999 of 2021-05-17 fixes bug 8812.
Card {card:4111 1111 1111 1111} expires 12/27.
paid with {card:5500-0000-0000-0004} on 3 May
Kartennummer {card:4012888888881881} gültig bis 08/26
tarjeta {card:3782 822463 10005} vence en 2028
carte {card:6011.1111.1111.1117} et code 123
{card:4222222222222220} {card:4012888888881881} are both blocked
numbers {card:5105105105105100} {card:4111111111111111} {card:378282246310005} end
on file: {phone:+1 (243) 555-5526} {card:4111111111111111} since 2019
und {phone:+1 (017) 555-7713} {card:5500000000000004} zu
call {phone:+44 20 7946 0958} {phone:+44 20 7946 0959} both lines
Call {phone:+1 (243) 555-5526} after 9 am.
Tel. {phone:+49 30 901820} or fax {phone:+49 30 901821}.
phone: {phone:(243) 555-0199}, ask for desk 4
Phone {phone:243-555-0142} is free from 8 to 5.
my number is {phone:555-0123}, call before 10
Rufen Sie {phone:030 / 901820} an, Zimmer 210.
Telefon: {phone:0049 30 5550 123} (täglich 9-17 Uhr)
Tél. {phone:01 42 68 53 00} de 9 h à 18 h
téléphone {phone:06.12.34.56.78} ou bureau 14
teléfono {phone:(91) 555 01 23} hasta las 20
llame al {phone:34-91-555-0188} hoy
toll free {phone:1-800-555-0199} in all 50 states
Mobile: {phone:+33 6 12 34 56 78} / office {phone:+33 1 42 68 53 00}
cell {phone:(555) 010-2233}, born 1984
The years 1990-1995 and 2001-2004 were dry.
On 2024-03-15 at 12:30:45 the test ended with 99.8 percent.
ISBN 978-3-16-148410-0 costs 24.95 or 2 for 45.00.
Order 4736962 of 15/03/2024 has 3 items at 1,299.00 each.
Invoice no. 2024-000123, 12 000 000 units, 7 % off
pages 112-118, 220, 300-310 and 12
He ran 100 m in 9.58 s and 200 m in 19.19 s.
Add 250 g flour, 3 eggs, 1/2 l milk, bake 45 min at 180 degrees.
1 2 3 4 5 6 7 8 9 10 11 12
12.5 13.7 18.2 20.1 19.9 17.3 15.0
Latitude 52.5200, longitude 13.4050, height 34 m
id 9807915762804490 ref 2390409500648961 lot 77
key 48451681144073 29 88 10 11
serial 0012 3456 7890 in box 3
account 12345678 at branch 40-12
case 2019-CV-00123, docket 44, 5 U.S. 137 (1803)
score 3-2 after 90 minutes, 21-19 in set 3
x = 3 + 4 * 12 - 5 / (7.25 - 1)
Chapter 3: the 7 years from 1618 to 1625
Art. 12 Abs. 3 Satz 1, BGBl. I S. 1234
Bus 100 fährt um 8.15, 8.35 und 8.55 Uhr
El 25 % de 1.200.000 habitantes en 1998
Les 3 et 4 mai 1789, 1.139 députés
room 12-34, floor 3, box 5678
A4 210 x 297 mm, A3 297 x 420 mm
ratio 1:1000000, 16:9 and 4:3
the quick fox {email:fox.12@den7.example.com} ran over the lazy dog
über alle Berge {email:wolf.99@wald3.example.de}, weiter nicht
la casa {email:sol_4@mar2.example.es} está cerca. Otra vez
sous le pont {email:ane.77@pre9.example.fr} coule la rivière
{email:k9@zoo.example.org} was seen again.
one more line with {email:a-b@c-d.example.co.uk}; then the end
north of the river {phone:+1 (555) 010-4477} the road turns
bis zum Abend {phone:+49 (30) 555-0101} und weiter
por la tarde {phone:+34 (91) 555-0177}. Luego
au matin {phone:+33 (1) 555-0133}, puis rien
{phone:+1 (212) 555-0100} stood on the wall
some words {phone:+1 (415) 555-0111} {ip:10.1.2.3} some more words
Wort {ip:172.31.255.4} {phone:+43 (1) 555-0155} Wort
a line {phone:+1 (312) 555-0122} {email:pat.8@hut.example.net} of words
in the hills {ip:10.200.30.4} the snow stays long
der Weg {ip:198.51.100.77} ist weit, sehr weit.
el camino {ip:203.0.113.9}, la noche
{ip:192.0.2.255} puis le vent se lève
words before {card:4111111111111111} and words after it
viele Worte {card:5500000000000004}, noch mehr Worte
unas palabras {card:4012888888881881}. Y otras
quelques mots {card:5105105105105100} et d'autres
here {card:4111111111111111} {card:5105105105105100} there
near {phone:+1 (617) 555-0188} {card:4012888888881881} far
it holds 2390409500648962 grains, not 4736962973099582 of them
zusammen 9807915762804491 Teile und 4845168114407321 Stücke
1984 was a year, 42 a number, 1000000 a lot
"""


def labelled_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(line,) for line in LABELLED.strip().splitlines()], "marked string")


FOUND = "doc_id bigint, text string, base array<struct<start:int,kind:string,end:int>>, added array<struct<start:int,kind:string,end:int>>"


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, base and added (arrays of start, kind, end; by start, then in the order of KINDS), with keep_text also text."""

    def work(record_batches) -> Iterator[dict]:
        told = lambda spans: [{"start": a, "kind": KINDS[k], "end": b} for a, k, b in spans]
        for batch in record_batches:
            column = batch.column(1)
            texts = [t or "" for t in column.to_pylist()]
            for start, end in chunks(texts, PIECE):
                few = texts[start:end]
                base = [base_spans(t) for t in few]
                added = [added_spans(t, b, p) for t, b, p in zip(few, base, proposed(few, field))]
                yield {"doc_id": batch.column(0).slice(start, end - start), "base": [told(b) for b in base], "added": [told(a) for a in added],
                       "text": column.slice(start, end - start) if keep_text else [None] * (end - start)}

    found = mapped(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), work, FOUND)
    return found if keep_text else found.drop("text")


def written(spans: str):
    """An array of spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def in_order(spans):
    """Spans by start, then in the order of KINDS."""
    rank = lambda s: F.array_position(F.lit(list(KINDS)), s.kind)
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), rank(s).alias("rank"), s.end.alias("end"), s.kind.alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
