import hashlib
import random
import re
import time

import pytest
from helpers import clashing, collected, documents

from stratalake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base kinds by their patterns alone."""
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15],
    }


def texts():
    rng = random.Random(6)
    seeds = ["a@b.c", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "x@y", "é@b.com", "iban: DE89370400440532013000", " ", "+", ".", "@", "-", "0", "007.008.009.010"]
    out = [None, "", *seeds]
    out += ["".join(rng.choice(seeds) for _ in range(rng.randrange(1, 6))) for _ in range(1500)]
    out += ["".join(rng.choice("a1@.-+ ()%_é") for _ in range(rng.randrange(40))) for _ in range(3000)]
    return out + ["9" * 60_000, "1." * 9000, "a@" * 9000, "+1" * 9000]


def test_base_kinds_match_their_patterns(spark):
    every = texts()
    got = pii.find_personal(clashing(documents(spark, every)))
    want = []
    for i, t in enumerate(every):
        found = plain(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in found[k])
        want.append((i, *(len(found[k]) for k in pii.BASE_KINDS), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(map(tuple, got.drop("spans", "n_spans").collect())) == want
    for row in got.collect():
        base = [s for s in row.spans.split(",") if s.split(":")[0] in pii.BASE_KINDS]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == row.base_sha256
        assert row.n_spans == len(row.spans.split(",")) if row.spans else row.n_spans == 0


def kinds(text):
    return {k: [text[a:b] for a, b in v] for k, v in pii.spans(text).items() if v}


def test_anchors():
    assert kinds("Write to müller@exämple.de.") == {"mailbox": ["müller@exämple.de"]}
    assert kinds("see https://bob:pw@host.example/x).")["address"] == ["https://bob:pw@host.example/x"]
    assert "address" not in kinds("see https://host.example/page?id=3")
    assert kinds("tel:030-1234567") == {"address": ["tel:030-1234567"]}
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 ok")["account"] == ["DE89 3704 0044 0532 0130 00"]
    assert "account" not in kinds("IBAN: DE88 3704 0044 0532 0130 00")
    assert kinds('api_key = "24be64439e3e49cf46b2"')["account"] == ["24be64439e3e49cf46b2"]
    assert kinds("the token was given to a secret account of hers") == {}


def plain_address(text, start, after):
    """The link of one scheme by itself: the whole rest of its run is read."""
    end = pii.URL_TAIL.match(text, after).end()
    while end > after and text[end - 1] in ".,;:!?)]":
        end -= 1
    scheme, rest = text[start:after].lower(), text[after:end]
    if scheme in ("mailto:", "sip:"):
        fits = "@" in rest[1:] and pii.DOMAIN.match(rest, rest.index("@") + 1)
    elif scheme == "tel:":
        fits = 7 <= sum(c.isdecimal() for c in rest) <= 15
    else:
        fits = "@" in re.split(r"[/?#]", rest, maxsplit=1)[0][1:] or pii.PERSONAL_QUERY.search(rest)
    return (start, end) if fits else None


def plain_account(text, cue, start, after):
    whole = re.compile(pii.AFTER_CUE.pattern + "(" + pii.VALUE.pattern + "(?: [0-9]{2,})*)", re.I)
    found = whole.match(text, after)
    if start and text[start - 1].isalnum() or found is None or found.start(1) == after:
        return None
    begin, end = found.span(1)
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    value = text[begin:end]
    plain = re.sub(r"[ ./_+-]", "", value)
    digits = sum(c.isdecimal() for c in plain)
    if cue == "iban":
        fits = pii.iban(value)
    elif cue in ("ssn", "social security"):
        fits = plain.isdecimal() and digits == 9
    elif cue == "passport":
        fits = 6 <= len(plain) <= 12 and digits >= 5
    else:
        fits = len(plain) >= 8 and digits >= 4
    return (begin, end) if fits else None


def test_links_and_identifiers_one_by_one():
    """What the kept state of a run finds is what each anchor finds by itself."""
    rng = random.Random(8)
    seeds = ["http://", "https://", "FTP://", "mailto:", "tel:", "sip:", "@", "a@b.c", "/", "?", "#", "&token=", "?email=x", "iban", "IBAN ", "account", "ssn ", "passport ", "token", "token1/",
             "api key", "id", "no.", "number ", " is ", ":", "=", "'", "1", "12", "123456789", " 44", "DE89370400440532013000", "x", "é", "ſ", "K", ".", "-", "_", " ", "\n", ",", ")", "<", "a.b"]
    for _ in range(30_000):
        text = "".join(rng.choice(seeds) for _ in range(rng.randrange(1, 25)))
        want = {"address": [], "account": []}
        for last, (anchor, length) in pii.anchors_of(text):
            start, after = last + 1 - length, last + 1
            kind = {"scheme": "address", "cue": "account"}.get(anchor)
            if kind:
                span = plain_address(text, start, after) if kind == "address" else plain_account(text, text[start:after].lower(), start, after)
                if span and (not want[kind] or span[0] >= want[kind][-1][1]):
                    want[kind].append(span)
        found = pii.spans(text)
        assert {kind: found[kind] for kind in want} == want, text


@pytest.mark.parametrize("bit", ["http://", "mailto:", "token1/", "iban ", "tokenid1/", "tokenida/", "tel:1", "sip:@", "mailto:@a", "http://x?user", "a@b.", "é@é.", "@", "1.", "+1", "x"])
def test_a_megabyte_takes_seconds(bit):
    started = time.perf_counter()
    pii.spans(bit * (1_000_000 // len(bit)))
    assert time.perf_counter() - started < 10


def test_far_ends():
    assert len(pii.spans("mailto:" * 50_000 + "@" + "a" * 300_000)["address"]) == 0
    assert pii.spans("http://x" * 50_000 + "?user=1")["address"] == [(0, 400_007)]


def test_redact():
    text = "a@b.co, 1.2.3.4 and https://x@b.co/1.2.3.4 end"
    assert pii.redact(text, pii.spans(text)) == "<EMAIL>, <IP> and <ADDRESS> end"


def test_mask_keeps_rows_and_clean_texts(spark):
    docs = clashing(documents(spark, [None, "", "clean text", "mail a@b.co now", "clean text"], [None, 1, 2, 3, 2]))
    masked = pii.mask_personal(docs)
    assert masked.columns == docs.columns
    want = documents(spark, [None, "", "clean text", "mail <EMAIL> now", "clean text"], [None, 1, 2, 3, 2])
    assert collected(masked, "doc_id", "text", "n_chars") == collected(want, "doc_id", "text", "n_chars")


def test_empty_table(spark):
    assert pii.find_personal(documents(spark, [])).collect() == []
    assert pii.mask_personal(documents(spark, [])).collect() == []
