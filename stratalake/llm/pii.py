"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, schemes (``https://``, ``mailto:``,
``tel:``) and cues that announce an identifier (``iban``, ``token``, ``ssn``). A small deterministic
parser for each kind of anchor grows the match to its boundaries and validates it. The four base
kinds (email, ip, card, phone) follow fixed patterns and are always there; the anchors add
``account`` (an identifier behind a cue), ``address`` (a link that carries a login, a mailbox or a
number) and ``mailbox`` (an address with letters beyond ASCII).
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.llm.common import bound_batches, columns_of, id_and_text, like_documents, texts_of, worker_cache

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("account", "address", "mailbox")
KINDS = BASE_KINDS + EXTRA_KINDS

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits that fails from its first digit fails from all others, so only first digits are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.\w{2,}")
URL_TAIL = re.compile(r"[^\s<>\"'`|\\^{}]*")
PERSONAL_QUERY = re.compile(r"[?&;](?:e-?mail|user|login|password|passwd|token|api_?key|ssn|phone)=[^&;#]", re.I)
HOST_END = re.compile(r"[/?#]")
#: What may stand between a cue and its value, the value's first run, and further groups of digits.
AFTER_CUE = re.compile(r"[\s]{0,3}(?:number|no\.?|nr\.?|id|is|#)?[\s]{0,3}[:=#]?[\s]{0,3}[\"']?(?=[A-Za-z0-9])", re.I)
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_/+.-]*", re.I)
VALUE_TAIL = re.compile(r"(?: [0-9]{2,})*")
#: Code points of an IBAN of 34 characters in the smallest groups.
LONGEST_IBAN = 68

SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:", "sip:")
CUES = (
    "iban", "account", "acct", "ssn", "social security", "passport", "license number", "customer id", "member id",
    "token", "api_key", "api key", "apikey", "secret", "password", "passwd", "access key",
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", plain):
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def anchors():
    """Automaton over at-signs, schemes and cues, the last two in lower, upper and title case."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            for form in {word, word.upper(), word.capitalize(), word.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def anchors_of(text: str):
    """(last place, (kind, length)) of every anchor in ascending order."""
    return worker_cache("pii anchors", anchors).iter(text)


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign: the longest local part not before ``floor``, then a dotted domain."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at or (domain := DOMAIN.match(text, at + 1)) is None:
        return None
    return start, domain.end()


def mailbox_at(text: str, at: int) -> tuple[int, int] | None:
    """An address whose local part or domain has letters beyond ASCII."""
    start = at
    while start > 0 and (text[start - 1] in LOCAL or (text[start - 1] > "\x7f" and text[start - 1].isalnum())):
        start -= 1
    domain = WIDE_DOMAIN.match(text, at + 1)
    if start == at or domain is None or text[start : domain.end()].isascii():
        return None
    return start, domain.end()


class Links:
    """Links from their schemes, taken in ascending order, if they name a login, a mailbox or a number.

    All schemes of one blank-free run share its end, and what follows them there: the next at-sign, slash or
    personal query and the digits left are kept, so each code point is looked at a bounded number of times.
    """

    def __init__(self, text: str):
        self.text, self.run = text, -1

    def enter(self, after: int):
        """Start the run that holds ``after``, unless it is the current one."""
        if after <= self.run:
            return
        self.run = end = URL_TAIL.match(self.text, after).end()
        while end > after and self.text[end - 1] in ".,;:!?)]":
            end -= 1
        self.end, self.marks, self.domains, self.counted, self.digits = end, {}, {}, None, 0

    def next(self, kind: str, after: int, find) -> int:
        """First place from ``after`` on that ``find`` gives, beyond the text if there is none."""
        if self.marks.get(kind, -1) < after:
            found = find(after)
            self.marks[kind] = len(self.text) if found < 0 else found
        return self.marks[kind]

    def next_at(self, after: int, end: int) -> int:
        return self.next("@", after, lambda start: self.text.find("@", start, self.end))

    def mailbox(self, after: int, end: int) -> bool:
        at = self.next_at(after, end)
        if at >= end or (at == after and self.text.find("@", after + 1, end) < 0):
            return False
        if at not in self.domains:
            self.domains[at] = DOMAIN.match(self.text, at + 1, end) is not None
        return self.domains[at]

    def number(self, after: int, end: int) -> bool:
        if self.counted is None:
            self.digits = sum(c.isdecimal() for c in self.text[after:end])
        else:
            self.digits -= sum(c.isdecimal() for c in self.text[self.counted : after])
        self.counted = after
        return 7 <= self.digits <= 15

    def login(self, after: int, end: int) -> bool:
        slash = self.next("/", after, lambda start: found.start() if (found := HOST_END.search(self.text, start, self.end)) else -1)
        if self.text.find("@", after + 1, min(slash, end)) >= 0:
            return True
        return self.next("query", after, lambda start: found.start() if (found := PERSONAL_QUERY.search(self.text, start, self.end)) else -1) < end

    def at(self, start: int, after: int) -> tuple[int, int] | None:
        """The link of the scheme from ``start`` to ``after``, to its end."""
        self.enter(after)
        scheme, end = self.text[start:after].lower(), max(self.end, after)
        fits = self.mailbox if scheme in ("mailto:", "sip:") else self.number if scheme == "tel:" else self.login
        return (start, end) if fits(after, end) else None


class Identifiers:
    """Identifiers behind cues, taken in ascending order: an IBAN, nine digits, or a code of at least 8 characters with 4 digits.

    Values that begin in one run of characters share its end; the letters and digits left are counted once."""

    def __init__(self, text: str):
        self.text, self.begin, self.run = text, -1, -1

    def measure(self, begin: int):
        """Set the end of the value that begins there."""
        if not self.begin <= begin < self.run:
            self.run = VALUE.match(self.text, begin).end()
            end = VALUE_TAIL.match(self.text, self.run).end()
            while end > begin and not self.text[end - 1].isalnum():
                end -= 1
            self.end, self.counted = end, None
        self.begin = begin

    def count(self):
        """Set ``digits`` and ``plain`` (letters and digits) of the value."""
        if self.counted is None:
            self.digits, self.plain = self.counts(self.begin, self.end)
        else:
            digits, plain = self.counts(self.counted, self.begin)
            self.digits, self.plain = self.digits - digits, self.plain - plain
        self.counted = self.begin

    def counts(self, begin: int, end: int) -> tuple[int, int]:
        """(digits, letters and digits)."""
        part = self.text[begin:end]
        return sum(map(part.count, "0123456789")), len(part) - sum(map(part.count, " ./_+-"))

    def at(self, cue: str, start: int, after: int, floor: int) -> tuple[int, int] | None:
        """The identifier behind the cue from ``start`` to ``after``, if it begins at ``floor`` or later."""
        if start and self.text[start - 1].isalnum() or (found := AFTER_CUE.match(self.text, after)) is None:
            return None
        begin = found.end()
        if begin == after or begin < floor:
            return None
        self.measure(begin)
        if cue == "iban":
            return (begin, self.end) if 15 <= self.end - begin <= LONGEST_IBAN and iban(self.text[begin : self.end]) else None
        self.count()
        if cue in ("ssn", "social security"):
            fits = self.plain == self.digits == 9
        elif cue == "passport":
            fits = 6 <= self.plain <= 12 and self.digits >= 5
        else:
            fits = self.plain >= 8 and self.digits >= 4
        return (begin, self.end) if fits else None


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) in code points of each kind, in ascending order; within a kind none overlap.

    The time grows with the length of the text alone, whatever its anchors."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    links, identifiers = Links(text), Identifiers(text)

    def floor(kind):
        return found[kind][-1][1] if found[kind] else 0

    def add(kind, span):
        if span is not None and span[0] >= floor(kind):
            found[kind].append(span)
            return True
        return False

    for last, (anchor, length) in anchors_of(text):
        start, after = last + 1 - length, last + 1
        if anchor == "at":
            if start < floor("email") or not add("email", email_at(text, start, floor("email"))):
                add("mailbox", mailbox_at(text, start))
        elif anchor == "scheme":
            if start >= floor("address"):
                add("address", links.at(start, after))
        else:
            add("account", identifiers.at(text[start:after].lower(), start, after, floor("account")))
    for match in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found["ip"].append(match.span())
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(match.span())
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(c.isdecimal() for c in match[0]) <= 15:
                found["phone"].append(match.span())
    return found


def joined(found: dict[str, list[tuple[int, int]]], kinds=KINDS) -> str:
    """kind:start:end of all spans, comma-joined, by kind and then by start."""
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in found[kind])


def redact(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in angle brackets."""
    every = sorted((start, -end, place, kind) for place, kind in enumerate(KINDS) for start, end in found[kind])
    out, at = [], 0
    for start, end, _, kind in every:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, -end)
    return "".join([*out, text[at:]])


def find_personal(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) of each row of ``docs(doc_id, text)``.

    Offsets are code points, the end exclusive. The counts by kind and ``base_sha256`` cover the base kinds,
    ``spans`` and ``n_spans`` all. Null and empty texts have none; ids may be null or repeated; other columns are not read.
    """
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in columns_of(batches):
            found = [spans(t) for t in texts_of(batch)]
            counts = [pa.array([len(f[kind]) for f in found], pa.int64()) for kind in BASE_KINDS]
            digests = [hashlib.sha256(joined(f, BASE_KINDS).encode()).hexdigest() for f in found]
            total = pa.array([sum(map(len, f.values())) for f in found], pa.int64())
            arrays = [batch.column("doc_id"), *counts, pa.array(digests), pa.array([joined(f) for f in found], pa.string()), total]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans", "n_spans"])

    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    return id_and_text(docs).mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_spans bigint")


def mask_personal(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind; texts without any, null ones too, are unchanged."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in columns_of(batches):
            new = [t and redact(t, spans(t)) for t in batch.column("text").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    return like_documents(docs.mapInArrow(run, docs.schema), docs)
