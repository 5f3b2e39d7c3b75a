"""Decontamination, personal data, host reputation and quality rules against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from deskquery.llm import decontamination, pii, quality_rules, url_filters

ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "one two three one two three x"), (6, "Ünïcode ÄB c\u00a0d \U0001f600 e"), (7, "w " * 3000), (8, "a b c\na b c\n\na b c\n \n"),
    (8, "a b c\na b c\n\na b c\n \n"), (9, "x\x0by\x0cz\r\n#* $%"), (None, "no id here"), (10, "THE!! OF!! " * 40), (11, "z" * 20000),
]


def docs(spark, rows=None):
    """Documents with a column whose name clashes with results."""
    return spark.createDataFrame([(i, t, "src", 7) for i, t in (ODD if rows is None else rows)], "doc_id long, text string, source string, n_words int")


def ledger_row(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 3)} if len(words) < 100 else set(range(len(words)))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated) if len(windows) > len(set(windows)) else 0


def test_ledger(spark):
    d = docs(spark)
    rows = quality_rules.ledger(d).collect()
    want = sorted((str(i), ledger_row(t)) for i, t in ODD if i != 10)
    assert sorted((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows if r.doc_id != 10) == want
    assert quality_rules.ledger(d.limit(0)).count() == 0
    masks = {r.doc_id: r.failed for r in rows}
    assert masks[1] & 1 and masks[7] & 2 and masks[10] & 64


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (2,), (4,)], "failed long")
    found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(rows).collect()}
    assert found["few_words"] == (2, 1) and found["repeated_words"] == (2, 1) and found["symbols"] == (1, 1)
    assert rows.filter(quality_rules.passes("base")).count() == 2


BENCH = [(1, "alpha beta gamma delta one two three four five six"), (2, "Short item"), (3, "solo"), (4, "--- ..."), (5, None), (6, "alpha beta gamma delta one two three four"), (10, "Ünï code é b c d e f g")]


def contaminated(text, bench):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        b = words(t)
        for i in range(max(1, len(b) - 7) if b else 0):
            x = b[i : i + 8]
            for j in range(len(w) - len(x) + 1):
                if w[j : j + len(x)] == x:
                    hit.update(range(j, j + len(x)))
                    items.add(str(item))
    return len(w), len(hit), len(items), sorted(items)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "MAX_BROADCAST", 0)
    long = "pad " * 500 + "Alpha, beta GAMMA delta one-two three four five six; " + "solo " * 30 + "short item"
    rows = [*ODD, (20, long), (20, long), (21, "alpha beta gamma delta one two three four"), (22, "alpha beta gamma delta one two three five"), (23, "Ünï code é b c d e f"), (None, "solo")]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"])) for r in decontamination.contamination(docs(spark, rows), bench).collect())
    assert got == sorted(str((i, *contaminated(t, BENCH))) for i, t in rows)
    assert {r.n_items for r in decontamination.contamination(docs(spark, rows), bench.limit(0)).collect()} == {0}
    assert decontamination.contamination(docs(spark, []), bench).count() == 0
    assert decontamination.clean(docs(spark, rows), bench).filter("doc_id IN (20, 21)").count() == 0


PII = [
    (1, "mail a.b+c@x-y.example.com, or x@y@z.org. ip 1.2.3.4.5.6.7.8 and 300.1.1.1 or 010.0.0.255!"),
    (2, "4111 1111 1111 1111 and 4111-1111-1111-1112 then 4111111111111111 5500005555555559"),
    (3, "+1 (132) 555-1352 call +49 30 1234567 or +1 2 and +1 (843) 555-7672 170.106.4.9"),
    (4, "ü a@b.c é +12345678901 \U0001f600 9.9.9.9"), (5, None), (6, ""), (7, "1" * 30000), (8, "a." * 20000 + "@"), (8, "1.2." * 9000), (9, "x" * 50000 + "@" + "y" * 50000), (None, "q@q.q"),
]


def base_spans(text):
    text = text or ""
    if len(text) > 25000:
        text = ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))), "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    found = [(m.start(), k, m.end(), kind) for k, (kind, (p, ok)) in enumerate(kinds.items()) for m in re.finditer(p, text) if ok(m[0])]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def test_pii(spark):
    table = docs(spark, PII * 3).select("doc_id", "text", pii.candidates(F.col("text")).alias("spans")).cache()
    model = pii.fit(table)
    rows = table.select("doc_id", "text", pii.chosen(F.col("spans"), model).alias("s")).select("doc_id", "text", pii.listed(F.filter("s", lambda x: x["base"])).alias("base"), pii.listed(F.col("s")).alias("spans")).collect()
    for r in rows:
        if len(r.text or "") <= 25000:
            assert r.base == ",".join(base_spans(r.text)), r.text
        assert set(r.base.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.fit(table.limit(0)).trees == []


@pytest.mark.parametrize("group", [1, 2, 3, 4, 16])
@pytest.mark.parametrize("sep", [" ", "-"])
def test_pii_card_groups(spark, group, sep):
    number = "4111111111111111"
    card = sep.join(number[i : i + group] for i in range(0, 16, group))
    rows = docs(spark, [(1, f"pay {card}"), (2, f"pay {card} now"), (3, f"in 2024 pay {card}x")])
    table = rows.select("doc_id", "text", pii.candidates(F.col("text")).alias("spans"))
    model = pii.boost([])
    got = {r.doc_id: (r.text, r.base) for r in table.select("doc_id", "text", pii.listed(pii.chosen(F.col("spans"), model)).alias("base")).collect()}
    for text, base in got.values():
        assert base == ",".join(base_spans(text)) and base.startswith("card:")
    assert {r.doc_id: r.text for r in pii.redacted(rows, model).collect()} == {1: "pay <card>", 2: "pay <card> now", 3: "in 2024 pay <card>x"}


def test_pii_learns(spark):
    good, bad = "see 4111111111111111 now", "see 4111111111111112 now"
    rows = [(i, good if i % 2 else bad) for i in range(200)] + [(999, "two 4111111111111111 4111111111111111 cards")]
    out = {r.doc_id: r for r in pii.redacted(docs(spark, rows)).collect()}
    assert out[1].text == "see <card> now" and out[0].text == bad and out[999].text == "two <card> <card> cards" and out[1].n_words == 7


def test_trees_agree(spark):
    cells = [{"kind": k % 4, "digits": k % 30, "groups": k % 9, "left": k % 4, "right": 0, "words": 0, "after": k % 5, "n": 5, "y": 5 * (k % 2)} for k in range(60)]
    model = pii.boost(cells)
    df = spark.createDataFrame([tuple(c[f] for f in pii.FEATURES) for c in cells], ", ".join(f"{f} int" for f in pii.FEATURES))
    span = F.struct(*pii.FEATURES)
    got = [r[0] for r in df.coalesce(1).select(model.score(span)).collect()]
    import math

    assert got == pytest.approx([1 / (1 + math.exp(-model.value(c))) for c in cells])


URLS = [
    (1, "http://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    (3, "https://example.com", "example.com", "", None, "allow"), (4, "x.net/es/", "", "", None, "allow"), (5, None, "", "", None, "allow"), (6, "http://b.net/es/?x", "b.net", "/es/", "net/es/", "block"),
    (7, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), (8, "http://net/fr/", "net", "/fr/", "net/fr/", "block"), (9, "ftp://h.org?a://b/c", "h.org", "", None, "allow"), (9, "ftp://h.org?a://b/c", "h.org", "", None, "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "kept") for i, u, *_ in URLS], "page_id long, url string, host string")
    got = [tuple(r) for r in url_filters.judge(pages).select("page_id", "url", "host", "path", "rule", "verdict").collect()]
    assert sorted(map(str, got)) == sorted(map(str, URLS))
    assert url_filters.judge(pages.limit(0)).count() == 0


def verdicts(spark, urls, rules=url_filters.RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [r.verdict for r in url_filters.judge(pages, rules).orderBy("page_id").collect()]


def test_urls_outcomes(spark):
    # Only block rules reach net: a host is blocked where most of its pages are, not where some are.
    spam = [f"http://spam.net/{'en' if i % 10 == 0 else 'es'}/{i}" for i in range(400)]
    half = [f"http://half.net/{'es' if i % 2 else 'en'}/{i}" for i in range(400)]
    fine = [f"http://h{i % 20}.net/en/{i}" for i in range(400)]
    got = dict(zip(spam + half + fine, verdicts(spark, spam + half + fine), strict=True))
    assert got["http://spam.net/en/0"] == "block" and got["http://half.net/en/0"] == "allow" and {got[u] for u in fine} == {"allow"}


def test_urls_without_outcomes(spark):
    # Hosts that no rule reaches are drawn from their neighbours, each of which counts once.
    bad = [f"http://d{i % 30}.co.uk/{i}" for i in range(3000)]
    one = [f"http://a{i % 9}.alone.org/{i}" for i in range(3000)]
    rules = tuple(("block", f"d{k}.co.uk", "/") for k in range(30)) + (("block", "alone.org", "/"),)
    urls = ["http://new.co.uk/", "http://www.d1.co.uk:80/", "http://new.org/", "http://other.uk/", "http://10.2.3.4/", *bad, *one]
    assert verdicts(spark, urls, rules)[:5] == ["block", "allow", "allow", "allow", "allow"]


def test_url_levels(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "uk", "a.b.example.com:8080", "10.2.3.4", "", "x"]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", *[c.alias(n) for n, c in url_filters.levels(F.col("host")).items()]).collect()
    assert [(r.domain, r.suffix) for r in rows] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("uk", "uk"), ("example.com", "com"), ("10.2.3.4", "10.2.3.4"), ("", ""), ("x", "x")]


def test_url_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/", 2, 3, 4, "x")], "page_id long, url string, row int, method int, reached int, `a.b` string")
    (r,) = url_filters.judge(pages).collect()
    assert (r["row"], r["method"], r["reached"], r["a.b"], r.verdict) == (2, 3, 4, "x", "block")


def test_digest_of_nothing(spark):
    assert spark.range(1).select(F.sha2(F.concat_ws(",", F.array().cast("array<string>")), 256)).first()[0] == hashlib.sha256(b"").hexdigest()
