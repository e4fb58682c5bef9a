"""Spans of personal data against a plain reading of the patterns."""

import hashlib
import random
import re

from patchloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                good = all(int(x) <= 255 for x in m[0].split("."))
            elif kind == "card":
                weights = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
                good = 14 <= len(digits) <= 19 and sum(w // 10 + w % 10 for w in weights) % 10 == 0
            else:
                good = kind == "email" or 10 <= len(digits) <= 15
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    bits = ["a@b.c", "@", ".", "..", "1", "25", "256", "192.168.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-4567",
            "+", "-", " ", "é", "\n", "(", "x.y+z@mail.example.com", "00.1.2.3", "0000000000000000", "😀", "1.2.3.4.5"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("1" * 400_000, "a" * 400_000, "a@" * 200_000, "+1 " * 100_000, "1." * 200_000, "a.b@" * 100_000):
        pii.base_spans(text)
        pii.added_spans(text, [], 0.7)


def test_many_spans_take_linear_time():
    import time

    text = "".join(f"u{i}@mail.example.com 24be64439e3e49cf46b2d7c90f3602a{i:09x} token ssn 123-45-{1 + i % 9999:04d} " for i in range(34_000))
    base = pii.base_spans(text)
    start = time.perf_counter()
    added = pii.added_spans(text, base, 0.7)
    assert len(base) == 34_000 and len(added) == 68_000 and time.perf_counter() - start < 3


def test_added_spans_equal_a_plain_search():
    rng = random.Random(5)
    bits = ["a@b.co", "123-45-6789", "ssn", "4111 1111 1111 1111", "DE89370400440532013000", "key_" + "a1" * 16, "token", "+49 30 123-45-6789", " ", " ", "x"]

    def plain_added(text, taken):
        out = []
        for kind, rule in pii.ADDED.items():
            for s, e in rule.candidates(text):
                if any(s < b and a < e for _, a, b in [*taken, *out]):
                    continue
                score = rule.base + (0 if rule.check is None else pii.CHECKED if rule.check(text[s:e]) else -pii.CHECKED)
                near = (text[max(0, s - pii.WINDOW): s] + " " + text[e: e + pii.WINDOW]).lower()
                score += pii.NEARBY * any(w in rule.words for w in pii._WORD.findall(near))
                out += [(kind, s, e)] * (score >= 0.7)
        return out

    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        base = pii.base_spans(text)
        assert pii.added_spans(text, base, 0.7) == plain_added(text, base), text


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def test_context_and_checksum_decide_added_kinds():
    kinds = lambda t: [k for k, _, _ in pii.added_spans(t, [], 0.7)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 ok") == ["iban"]
    assert kinds("DE89370400440532013000") == ["iban"]
    assert kinds("IBAN DE89370400440532013001") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"') == ["secret"]
    assert kinds("commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff") == []


def test_rows(spark):
    card = "pay 4111 1111 1111 1111 or a@b.co"
    rows = [(1, card, "x"), (2, None, None), (3, "", "y"), (None, "ip 10.0.0.1", "z"), (1, card, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = sorted((tuple(r) for r in pii.digest(pii.personal_data(df, ["doc_id"])).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    both = "card:4:23,email:27:33"
    assert out == sorted([
        (1, 1, 0, 1, 0, sha(both), both), (1, 1, 0, 1, 0, sha(both), both), (2, 0, 0, 0, 0, sha(""), ""), (3, 0, 0, 0, 0, sha(""), ""),
        (None, 0, 1, 0, 0, sha("ip:3:11"), "ip:3:11")], key=str)
    assert pii.personal_data(df.limit(0), ["doc_id"]).count() == 0


def test_masking_keeps_columns_and_sets_the_length(spark):
    df = spark.createDataFrame([(1, "mail a@b.co now", 15, "b"), (2, None, None, "c"), (3, "clean", 5, None)], "doc_id long, text string, n_chars long, base string")
    rows = [tuple(r) for r in pii.masked_documents(df).collect()]
    assert rows == [(1, "mail [EMAIL] now", 16, "b"), (2, None, None, "c"), (3, "clean", 5, None)]
    # a phone number can lie over a card number: what the second adds is masked as well
    assert pii._masked("abcdef", [("phone", 1, 4), ("card", 2, 5)]) == "a[PHONE][CARD]f"


def test_account_numbers_end_where_their_country_says():
    found = lambda t: [t[s:e] for k, s, e in pii.added_spans(t, [], 0.7) if k == "iban"]
    german, british = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    assert found("DE89370400440532013000 BIC COBADEFFXXX") == ["DE89370400440532013000"]
    assert found(f"{british} BIC NWBKGB2L") == [british]
    assert found(f"{german} I will") == found(f"{german} 12 May") == [german]
    assert found(f"{german} {british} OK") == [german, british]
    assert found("DE8937040044053201300012") == found("DE89 3704 0044 0532 0130 01 BIC") == []
    body = "1234567890123"  # no country of the table
    check = 98 - int(body + "".join(str(int(c, 36)) for c in "ZZ") + "00") % 97
    assert found(f"ZZ{check:02d}{body} AND MORE") == [f"ZZ{check:02d}{body}"]


def test_masking_keeps_columns_in_order(spark):
    rows = spark.createDataFrame([(32, "mail x@y.org", 1), (0, None, 2)], "n_chars int, Text string, doc_id long")
    out = pii.masked_documents(rows)
    assert out.schema.names == rows.schema.names and out.schema["n_chars"].dataType == rows.schema["n_chars"].dataType
    assert sorted(map(tuple, out.collect())) == [(0, None, 2), (12, "mail [EMAIL]", 1)]
