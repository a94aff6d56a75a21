import datetime as dt
import re

import pytest

from daybook.llm import pii


def run(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(pii.pseudonymise(docs, **options).collect(), key=lambda r: r.doc_id)]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


CARD, IP, PHONE = "4111 1111 1111 1111", "192.168.10.254", "+1 (988) 555-2485"
TEXTS = [
    f"pay {CARD} now", "same 4111-1111-1111-1111, other 4012888888881881.", "wrong check 4111111111111112 stays",
    f"host {IP}, not 300.1.1.1 nor 1.2.3", f"call {PHONE} or +44 20 7946 0958.", "born 1984-02-29 or 29.02.1984 or 02/29/1984; not 1983-02-29",
    "ssn 219-09-9999, not 000-12-3456", "mail bob.37@mail4.example.com!", 'token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" x',
    "plain 12 words, version 2.0, 1234 and 3.", "", None, "@ 1",
]


def test_formats_are_kept_and_values_linked(spark):
    out = [r.text for r in run(spark, TEXTS)]
    card = re.search(r"pay (\d{4} \d{4} \d{4} \d{4}) now", out[0])[1]
    assert card != CARD and luhn(card.replace(" ", ""))
    linked, other = re.search(r"same ([\d-]{19}), other (\d{16})\.", out[1]).groups()
    assert linked.replace("-", "") == card.replace(" ", "") and luhn(other) and other != "4012888888881881"
    assert out[2] == TEXTS[2] and out[9:] == TEXTS[9:]
    ip = re.search(r"host ([\d.]+), not 300.1.1.1 nor 1.2.3", out[3])[1]
    assert ip != IP and all(0 <= int(x) <= 255 for x in ip.split("."))
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+44 \d\d \d{4} \d{4}\.", out[4]) and "555-2485" not in out[4]
    a, b, c = re.search(r"born (\S+) or (\S+) or (\S+); not 1983-02-29", out[5]).groups()
    day = dt.date.fromisoformat(a)
    assert day != dt.date(1984, 2, 29) and b == day.strftime("%d.%m.%Y") and c == day.strftime("%m/%d/%Y")
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}, not 000-12-3456", out[6]) and "219-09-9999" not in out[6]
    assert re.fullmatch(r"mail u[0-9a-f]{12}@mail4\.example\.com!", out[7])
    assert re.fullmatch(r'token = "[0-9a-f]{40}" x', out[8]) and out[8] != TEXTS[8]


def test_counts(spark):
    rows = run(spark, TEXTS)
    assert [{p.kind: p.n for p in r.pii} for r in rows] == [
        {"card": 1}, {"card": 2}, {}, {"ipv4": 1}, {"phone": 2}, {"date": 3}, {"ssn": 1}, {"email": 1}, {"secret": 1}, {}, {}, {}, {}]


def test_exact_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    back = pii.pseudonymise(pii.pseudonymise(docs, key="k").drop("pii"), key="k", back=True)
    got = {r.doc_id: r.text for r in back.collect()}
    assert all(got[i] == t for i, t in enumerate(TEXTS) if not t or "@mail" not in t)
    other = pii.pseudonymise(docs, key="l").collect()
    assert {r.text for r in other}.isdisjoint({r.text for r in pii.pseudonymise(docs, key="k").collect() if r.pii})


@pytest.mark.parametrize("n", [2, 3])
def test_digits_are_permuted(spark, n):
    df = spark.range(10**n).selectExpr(f"lpad(id, {n}, '0') AS d")
    got = [r.p for r in df.select(pii.permute_digits(df.d, "t", "k").alias("p")).collect()]
    assert len(set(got)) == 10**n and all(len(x) == n for x in got)


def test_days_are_permuted(spark):
    df = spark.range(146097).selectExpr("date_format(date_add(date'1800-01-01', int(id)), 'yyyy-MM-dd') AS text")
    got = df.select(pii._date(df.text, "k", False).alias("p"))
    assert got.distinct().count() == 146097
    r = got.selectExpr("min(p)", "max(p)").first()
    assert tuple(r) == ("1800-01-01", "2199-12-31")


def test_edges(edge_docs, no_docs):
    out = pii.pseudonymise(edge_docs)
    assert out.columns == [*edge_docs.columns, "pii"]
    assert sorted(map(str, (r[:-1] for r in out.collect()))) == sorted(map(str, (tuple(r) for r in edge_docs.collect())))
    assert pii.pseudonymise(no_docs).count() == 0


BESIDE = ["4111 1111 1111 1111 12/26", "4111 1111 1111 1111 123 x", "4111-1111-1111-1111 9 end", "12 4111 1111 1111 1111.", "378282246310005 1226 z"]


def test_card_beside_other_digits_is_found(spark):
    rows = run(spark, BESIDE)
    assert [{p.kind: p.n for p in r.pii} for r in rows] == [{"card": 1}] * len(BESIDE)
    for r, old in zip(rows, BESIDE):
        card = next(c for c in ("4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005") if c in old)
        before, after = old.split(card)
        new = r.text[len(before) : len(before) + len(card)]
        assert r.text == before + new + after and new != card and luhn(re.sub(r"\D", "", new))
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", card)


def test_national_phones_are_found(spark):
    texts = ["call 555-123-4567.", "or 020 7946 0958!", "at 1-555-123-4567", "tel 01 23 45 67 89", "on 01-02-2024, 100 200 300 and 12-34-56 stay"]
    rows = run(spark, texts)
    assert [{p.kind: p.n for p in r.pii} for r in rows] == [{"phone": 1}] * 4 + [{}]
    forms = [r"call \d{3}-\d{3}-\d{4}\.", r"or 0\d\d \d{4} \d{4}!", r"at 1-\d{3}-\d{3}-\d{4}", r"tel 0\d( \d\d){4}"]
    assert all(re.fullmatch(f, r.text) and r.text != t for f, r, t in zip(forms, rows, texts)) and rows[4].text == texts[4]


def test_cards_and_phones_beside_digits_come_back(spark):
    # many codes, so that other candidates pass Luhn by chance on the way
    texts = [f"{a}4111 1111 1111 {1000 + i} {c}" for i in range(200) for a, c in (("", "12"), ("", "123 x"), ("77 ", "9"))]
    texts += [f"{100 + i}-123-{4000 + i} 020 7946 {1000 + i}" for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    there = pii.pseudonymise(docs, key="k").drop("pii")
    back = {r.doc_id: r.text for r in pii.pseudonymise(there, key="k", back=True).collect()}
    assert [back[i] for i in range(len(texts))] == texts


def test_grouped_numbers_stay_valid_and_come_back(spark):
    """A hundred thousand of them, the corners of the range too."""
    plain = spark.range(100_000).selectExpr(
        "CASE id WHEN 0 THEN '001-01-0001' WHEN 1 THEN '999-99-9999' "
        "ELSE format_string('%03d-%02d-%04d', 1 + (id * 7919) % 999, 1 + (id * 104729) % 99, 1 + (id * 15485863) % 9999) END AS text").distinct()
    rows = [r.text for r in plain.collect()]
    new = pii.pseudonymise(spark.createDataFrame([(t,) for t in rows], "text string")).select("text")
    out = [r.text for r in new.collect()]
    assert all(re.fullmatch(r"(?!000)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", t) for t in out)
    assert len(set(out)) == len(rows) > 90_000 and sum(a == b for a, b in zip(rows, out)) < 5
    assert [r.text for r in pii.pseudonymise(new, back=True).collect()] == rows


def test_hex_secrets_of_any_length(spark):
    """31, 47 and 63 digits too, which don't halve into 64-bit numbers; 15 are none."""
    texts = [f"api_key={('9f' * 50)[:n]} end" for n in (*range(15, 66), 80)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    new = [r.text for r in pii.pseudonymise(docs).collect()]
    assert new[0] == texts[0] and all(a != b and len(a) == len(b) for a, b in zip(new[1:], texts[1:]))
    back = pii.pseudonymise(spark.createDataFrame([(t,) for t in new], "text string"), back=True)
    assert [r.text for r in back.collect()] == texts
