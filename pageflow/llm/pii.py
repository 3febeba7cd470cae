"""Personal data in text: exact base patterns, and a semi-Markov conditional random field that adds what they miss.

The base patterns of e-mail, address, card and phone are fixed. The random field scores whole candidate spans of up to
`MOST_WORDS` words (their shape, digit groups, check digits, separators) for each kind, and a dynamic program chooses
boundaries and kinds together. Words without a digit, an @ or a spelt-out "(at)" fire no feature, so the program
falls apart into short runs of the other words without loss. The field is trained on the driver from built-in examples,
at most `SAMPLE` documents with base spans as labels, and rewritten and broken variants of both.
"""

import hashlib
import math
import random
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import prepared, sampled, table

# Kinds in the order of the contract, and its patterns. A run of numbers and dots is cut into fours.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Pieces of words in a candidate span at most, more than any positive variant below has.
MOST_WORDS = 16
# Documents the field is fitted on at most, their characters at most, and how much better than nothing a span must score.
SAMPLE, SAMPLE_CHARS, MARGIN = 400, 20_000, 1.0
# Spans up to this length keep their scores for when they come again.
KEPT_CHARS = 200

ACTIVE = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]", re.IGNORECASE)
TAIL = re.compile(r"[^\x20\x09-\x0D]*")
SPELT = re.compile(r"[(\[](at|dot)[)\]]", re.IGNORECASE)
RUNS = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
WHITE = " \t\n\x0b\x0c\r"
# Pieces of a word: characters that spans are made of. Quotes, colons, equals signs, commas and other scripts part them.
PIECE = re.compile(r"[A-Za-z0-9._%+@()\[\]-]+")

EXAMPLES = {
    "email": ("mary.smith@mail.example.org", "info@example.com", "k-lee+news@post.example.co.uk"),
    "ip": ("192.0.2.17", "198.51.100.4", "203.0.113.250"),
    "card": ("4111111111111111", "5500 0000 0000 0004", "4012-8888-8888-1881"),
    "phone": ("+1 (202) 555-0143", "+44 20 7946 0958", "+49-30-5550-1234"),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        digit *= 1 + place % 2
        total += digit - 9 * (digit > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by kind and start. Linear in the text."""
    spans = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            spans.append((0, start, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    for chain in NUMBERS.finditer(text):
        if chain[0].count(".") >= 3:
            parts = list(re.finditer("[0-9]+", chain[0]))
            for four in (parts[k:k + 4] for k in range(0, len(parts) - 3, 4)):
                if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                    spans.append((1, chain.start() + four[0].start(), chain.start() + four[3].end()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _digits(found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *found.span()))
    for found in PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_digits(found[0])) <= 15:
            spans.append((3, *found.span()))
    return spans


def pieces(text: str, start: int, end: int, beside: str = "") -> list[tuple[int, int]]:
    """The active pieces of a word; of one `beside` a spelt-out sign also the piece next to it ("before" or "after")."""
    found = [m.span() for m in PIECE.finditer(text, start, end)]
    near = {"before": len(found) - 1, "after": 0}.get(beside)
    return [p for k, p in enumerate(found) if k == near or ACTIVE.search(text, *p)]


def runs(text: str, taken: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring active pieces of words as (start, end), without pieces that overlap a base span.

    Every word is cut, whatever its length; as pieces of one word lie in one run, the whole word is a candidate as well.
    """
    found_, place, floor, size = [], 0, 0, len(text)

    def start_of(place: int) -> int:
        while place > floor and text[place - 1] not in WHITE:
            place -= 1
        return place

    while (found := ACTIVE.search(text, place)) is not None:
        start, end = start_of(found.start()), TAIL.match(text, found.start()).end()
        place = max(end, found.end())
        own = [(start, end, "")]
        if SPELT.search(text, start, end):
            before = start
            while before > 0 and text[before - 1] == " ":
                before -= 1
            if 0 < before and text[before - 1] not in WHITE:
                own.insert(0, (start_of(before - 1), before, "before"))
            after = end
            while after < size and text[after] == " ":
                after += 1
            if after < size and text[after] not in WHITE:
                own.append((after, TAIL.match(text, after).end(), "after"))
        found_ += [p for s, e, beside in own if s >= floor for p in pieces(text, s, e, beside)]
        place = floor = max(place, own[-1][1])
    result, ends = [], -10
    fixed = sorted((s, e) for _, s, e in taken)
    k, reach = 0, -1
    for start, end in found_:
        while k < len(fixed) and fixed[k][0] < end:
            reach, k = max(reach, fixed[k][1]), k + 1
        if reach > start:
            ends = -10
            continue
        gap = text[ends:start] if 0 <= start - ends <= 3 else "\n"
        if "\n" not in gap and (not gap.strip(WHITE) or not any(c in WHITE for c in gap)):
            result[-1].append((start, end))
        else:
            result.append([(start, end)])
        ends = end
    return result


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the punctuation around a span; brackets that belong to it stay."""
    while start < end and text[start] in "\"'<{,;:!?“”«»":
        start += 1
    while start < end and text[end - 1] in "\"'>},;:!?.“”«»":
        end -= 1
    if end - start > 1 and text[start] in "([" and text[end - 1] in ")]":
        start, end = start + 1, end - 1
    elif start < end and text[start] in "([" and ")" not in text[start:end] and "]" not in text[start:end]:
        start += 1
    elif start < end and text[end - 1] in ")]" and "(" not in text[start:end] and "[" not in text[start:end]:
        end -= 1
    return start, end


def features(span: str) -> list[str]:
    """What a whole span looks like."""
    plain = SPELT.sub(lambda m: "@" if m[1].lower() == "at" else ".", span.replace("[.]", "."))
    plain = re.sub(r" *([@.]) *", r"\1", plain) if plain != span else plain
    parts = RUNS.findall(plain)
    groups = [p for p in parts if "0" <= p[0] <= "9"]
    digits = "".join(groups)
    letters = any(p[0].isalpha() for p in parts)
    others = "".join(sorted({" " if p[0].isspace() else p for p in parts if not p[0].isalnum()}))
    shape = "".join(f"d{min(len(p), 20)}" if "0" <= p[0] <= "9" else "a" if p[0].isalpha() else " " if p[0].isspace()
                    else p for p in parts)
    if letters and "@" not in plain:
        return ["letters", "others " + others, f"lettered {len(digits) > 7}"]
    if "@" in plain:
        name, _, domain = plain.partition("@")
        good = bool(DOMAIN.fullmatch(domain)) and bool(name) and set(name) <= LOCAL
        return [f"mail {good}", f"mail {good} words {plain.count(' ')}"] + ["dot"] * (domain.count(".") if good else 0)  # a part is less than the whole
    found = [f"zeros {plain[:2] == '00'}", f"digits {min(len(digits), 20)}", f"groups {len(groups)}", "others " + others, "shape " + shape,
             "sizes " + "-".join(str(min(len(g), 20)) for g in groups)]
    if "(" in plain or ")" in plain:
        found.append(f"brackets {plain.count('(') == plain.count(')') == 1}")
    if len(digits) >= 13:
        found.append(f"luhn {luhn(digits)} {16 <= len(digits) <= 19} {others in ('', ' ', '-', '.')}")
    if others == "." and len(groups) == 4:
        found.append(f"four {all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    return found


class Field:
    """The random field: a weight for each (kind, feature)."""

    def __init__(self, weights: dict[tuple[int, str], float] | None = None):
        self.weights = weights or {}
        self.scores: dict[str, list[float]] = {}

    def score(self, span: str) -> list[float]:
        """Of a span, for each kind."""
        known = self.scores.get(span)
        if known is None:
            own = features(span)
            known = [sum(self.weights.get((k, f), 0.0) for f in own) - MARGIN for k in range(len(KINDS))]
            if len(self.scores) > 100_000:
                self.scores.clear()
            if len(span) <= KEPT_CHARS:
                self.scores[span] = known
        return known

    def best(self, text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The best set of spans over a run of words: one pass over ends, up to `MOST_WORDS` starts and all kinds each."""
        total, back = [0.0] * (len(words) + 1), [None] * (len(words) + 1)
        for j in range(1, len(words) + 1):
            total[j] = total[j - 1]
            for i in range(max(0, j - MOST_WORDS), j):
                start, end = trimmed(text, words[i][0], words[j - 1][1])
                if start >= end:
                    continue
                for kind, score in enumerate(self.score(text[start:end])):
                    if total[i] + score > total[j]:
                        total[j], back[j] = total[i] + score, (i, kind, start, end)
        spans, j = [], len(words)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind, start, end = back[j]
                spans.append((kind, start, end))
                j = i
        return spans[::-1]

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans), each by kind and start."""
        base = base_spans(text)
        more = [span for run in runs(text, base) for span in self.best(text, run)]
        return base, sorted(base + more)


def _variants(kind: int, span: str, rnd: random.Random) -> list[tuple[str, int | None]]:
    """A span and other spellings of it, with their kind, and broken ones, with None."""
    digits, kept = _digits(span), [(span, kind)]
    if kind == 0:
        name, _, domain = span.partition("@")
        dotted = domain.replace(".", " (dot) ")
        kept += [(f"{name} (at) {domain}", 0), (f"{name}[at]{domain}", 0), (f"{name} (at) {dotted}", 0),
                 (f"@{name}", None), (f"{name}@", None), (domain.replace(".", "4."), None)]
    elif kind == 1:
        parts = span.split(".")
        kept += [("[.]".join(parts), 1), (".".join(parts[:3]), None), (".".join(["999", *parts[1:]]), None),
                 (".".join(parts[:2]), None), (f"v{span}x", None)]
    elif kind == 2:
        broken = digits[:-1] + str((int(digits[-1]) + rnd.randint(1, 9)) % 10)
        kept += [(digits, 2), (".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), 2),
                 (broken, None), (" ".join(broken[i:i + 2] for i in range(0, len(broken), 2)), None), (digits[:rnd.randint(9, 14)], None), (f"{digits[:8]}ab{digits[8:]}", None),
                 ("-".join(broken[i:i + 4] for i in range(0, len(broken), 4)), None)]
    else:
        local = digits[-10:]
        if len(digits) >= 11:
            twos, ones = [" ".join(local[i:i + 2] for i in range(k, 10, 2)) for k in (0, 2)]
            kept += [(f"00{digits[:2]} {local[1]} {ones}", 3), (f"00{digits[:2]} {twos}", 3), (f"00{digits[:2]} {local[:3]} {local[3:6]} {local[6:]}", 3),
                     (f"{digits[:4]} {local[1]} {ones}", None), (f"{digits[:4]} {twos}", None), (f"{digits[:2]} {twos} {ones}", None),
                     (" ".join(local), None)]
            kept += [(f"({local[:3]}) {local[3:6]}-{local[6:]}", 3), (f"{local[:3]}-{local[3:6]}-{local[6:]}", 3),
                     (f"{local[:3]}.{local[3:6]}.{local[6:]}", 3), (f"00{digits[:-10]} {local[:3]} {local[3:6]} {local[6:]}", 3),
                     (f"{local[3:6]}-{local[6:]}", None), (local, None), (local[:4], None),
                     (f"{local[:4]}-{local[4:6]}-{local[6:8]}", None), (f"{local[:2]}.{local[2:4]}", None),
                     (f"({local[:2]})", None), (f"{local[:2]}:{local[2:4]}", None), (f"{local[:1]}-{local[1:3]}", None),
                     (f"{local[:3]}-{local[3]}-{local[4:6]}-{local[4:]}-{local[0]}", None)]
    return kept


def trained(texts: list[str], rounds: int = 10, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Maximises the conditional likelihood of the labelled runs, by gradient steps over forward and backward sums."""
    rnd = random.Random(7)
    examples = [(k, s) for k, kind in enumerate(KINDS) for s in EXAMPLES[kind]]
    examples += [(k, text[s:e]) for text in texts for k, s, e in base_spans(text)][:4 * SAMPLE]
    cases = []
    for kind, span in examples:
        for written, label in _variants(kind, span, rnd):
            cases.append((written, label))
    for k in range(0, len(cases) - 1, 3):  # neighbours in one run
        if cases[k][1] is None or cases[k + 1][1] is not None:
            cases.append((f"{cases[k][0]} {cases[k + 1][0]}", (cases[k], cases[k + 1])))
    runs_of = []
    for written, label in cases:
        parts = label if isinstance(label, tuple) else ((written, label),)
        words = [m.span() for m in PIECE.finditer(written)]
        gold, at = set(), 0
        for part, kind in parts:
            if kind is not None:
                gold.add((kind, at, at + len(part)))
            at += len(part) + 1
        table_ = []
        for j in range(1, len(words) + 1):
            for i in range(max(0, j - MOST_WORDS), j):
                start, end = trimmed(written, words[i][0], words[j - 1][1])
                if start < end:
                    own = features(written[start:end])
                    table_ += [(i, j, k, own, (k, words[i][0], words[j - 1][1]) in gold) for k in range(len(KINDS))]
        runs_of.append((len(words), table_))
    weights, seen = defaultdict(float), defaultdict(lambda: 1e-8)
    for _ in range(rounds):
        rnd.shuffle(runs_of)
        for size, table_ in runs_of:
            scores = [sum(weights[k, f] for f in own) for _, _, k, own, _ in table_]
            ahead, after = [0.0] + [-math.inf] * size, [-math.inf] * size + [0.0]
            ending, starting = defaultdict(list), defaultdict(list)
            for row, score in zip(table_, scores):
                ending[row[1]].append((row[0], score))
                starting[row[0]].append((row[1], score))
            for j in range(1, size + 1):
                ahead[j] = _logsum([ahead[j - 1], *[ahead[i] + s for i, s in ending[j]]])
            for i in range(size - 1, -1, -1):
                after[i] = _logsum([after[i + 1], *[after[j] + s for j, s in starting[i]]])
            for (i, j, k, own, gold), score in zip(table_, scores):
                step = gold - math.exp(min(0.0, ahead[i] + score + after[j] - ahead[size]))
                if abs(step) > 1e-3:
                    for f in own:
                        slope = step - decay * weights[k, f]
                        seen[k, f] += slope * slope
                        weights[k, f] += rate * slope / math.sqrt(seen[k, f])
    return Field(dict(weights))


def _logsum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


def fit(docs: DataFrame) -> Field:
    """Trained on at most `SAMPLE` different texts with a digit or an @ and under `SAMPLE_CHARS` characters, those with the
    smallest hashes. Without any, on the examples alone."""
    likely = docs.where(F.length("text") < SAMPLE_CHARS).where(F.col("text").rlike("@|[0-9]{7}|[0-9][.][0-9]+[.]|[+][0-9]"))
    return trained(sorted(row["text"] for row in sampled(likely, SAMPLE).collect()))


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (the base spans) and spans (all of them) of every document.

    One pass, no shuffle. A null text counts as empty; texts and words of any length are searched whole, and cut the same way.
    Rows with null or repeated doc_id are kept; no rows give none; other columns are ignored. Spans that the field adds never
    overlap a base span; of equally good sets of spans the one found first, with the shorter spans at its end, counts.
    """
    weights = field.weights

    def run(batches):
        own = Field(weights)
        for batch in batches:
            rows = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, spans = own.spans(text or "")
                counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                rows.append((number, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.string()) for c in columns[5:]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    parts, at, merged = [], 0, []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = end
    return "".join(parts) + text[at:]


def without_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with personal data masked in their text, in the columns they came with. Null texts stay null."""
    weights = field.weights

    def run(batches):
        own = Field(weights)
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = [None if t is None else masked(t, own.spans(t)[1]) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return personal_data(docs, fit(docs))
