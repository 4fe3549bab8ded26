"""Personal data: whole results against a plain version, and spans that the trees add."""

from __future__ import annotations

import re

import pytest

from solstrand.llm import pii
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[(](?:dot|DOT)[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
}


def side(c: str) -> int:
    if not c or re.fullmatch(r"[ \t\n\x0b\f\r]", c):
        return 0
    return 1 if re.match("[A-Za-z]", c) else 2 if re.match("[0-9]", c) else 3


def form(kind: str, found: str) -> int:
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+", found):
            return 0
        if re.fullmatch("[0-9a-z]+|[0-9A-Z]+", found):
            return 1
        if not re.search("[^0-9A-Za-z]", found):
            return 2
    if not re.search("[^0-9A-Za-z]", found):
        return 0
    if re.fullmatch("[0-9]{4}([ ./_-][0-9]{4})+", found):
        return 1
    return 2 if re.search(r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$", found) else 3


def secrets(text: str) -> list[tuple[int, int]]:
    """Whole runs of 16 or more characters with a digit and a letter."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9_/+-]+", text):
        run = m.group()
        if len(run) >= 16 and re.search("[0-9]", run) and re.search("[A-Za-z]", run):
            out.append(m.span())
    return out


def proposed(text: str | None) -> list[tuple]:
    """(kind, start, stop, base, cell) of each candidate."""
    text, out = text or "", []
    for n, kind in enumerate(pii.ALL_KINDS):
        for wide in (0, 1):
            if kind == "secret":
                places = secrets(text) if wide else []
            else:
                pattern = WIDE[kind] if wide else brute.PATTERNS[kind]
                places = [m.span() for m in re.finditer(pattern, text)]
            last = 0
            for a, b in places:
                found, before = text[a:b], text[max(last, a - pii.CONTEXT) : a]
                # What lies behind ends where the next match of the same list begins.
                after = "" if any(x == b for x, _ in places) else text[b : b + 1]
                last = b
                digits = len(re.sub("[^0-9]", "", found))
                size = sum(digits >= x for x in (7, 9, 12, 14, 16)) + (digits >= 17)
                cue = 1 if re.search(pii._CUES[kind], before) else 2 if re.search(pii._AGAINST, before) else 0
                cell = 0
                parts = (n, size, form(kind, found), side(before[-1:]), side(after), cue, wide)
                for bins, part in zip(pii.BINS.values(), parts, strict=True):
                    cell = cell * bins + part
                out.append((n, a, b, not wide and brute.valid(kind, found), cell))
    return out


def plain(text: str | None, cells: set[int]) -> str:
    found = [c for c in proposed(text) if c[3] or c[4] in cells]
    found.sort(key=lambda c: (c[1], not c[3], -c[2], c[0]))
    out, reach = [], 0
    for i, (n, a, b, base, _) in enumerate(found):
        free = reach <= a and all(b <= y for _, y, _, is_base, _ in found[i + 1 :] if is_base)
        if base or free:
            out.append((n, a, b))
        reach = max(reach, b)
    return brute.joined([(pii.ALL_KINDS[n], a, b) for n, a, b in sorted(out)])


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark)


def all_cells(spark, model, docs) -> set[int]:
    return set(pii.selected_cells(pii.candidates(docs.withColumnRenamed("doc_id", "id").selectExpr(
        "id AS r", "id AS doc_id", "text"), "r"), model))


ODD = [
    None, "", "7", "@", "a@b.cc", "my visa 4111 1111 1111 1112 ok", "order 4111111111111112 sent",
    'api_key: "Abc9Def8Ghi7Jkl6Mno5" ok', "joe[at]mail.org and jo (at) ma (dot) com", "call (212) 555-0187 now",
    "commit 11acdfb36bb72224148e6160f674b4be45601bff", "addr 2001:0db8:0000:0000:0000:ff00:0042:8329",
    "in 1999 and 2005-10-11", "+12 345 x", "https://a.b/xyz/abcdefgh1234567890", "card 4111_1111_1111_1112",
    "card number 4111 1111 1111 1112, tel. 212-555-0187, ip 300.1.2.3", "token=" + "a1" * 3000, "secret: " + "x" * 40,
    "phone +1 (743) 555-3824 and 743.555.3824", "key aaaaaaaaaaaaaaaa1 bbbbbbbbbbbbbbbb2",
    "card " + "1 " * 2000, "token = éabcdefgh1234567890", "mail\tjo@x.y.z card\n4111111111111111",
]


def test_whole_results_equal_a_plain_version(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(list(enumerate(ODD, 10**6)), "doc_id long, text string")
    docs = docs.unionByName(odd)
    cells = all_cells(spark, model, docs)
    got = {r.doc_id: r for r in pii.personal_data_digest(docs).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        want = plain(r.text, cells)
        assert got[r.doc_id].spans == want, (r.text[:200], want)
        assert got[r.doc_id].n_spans == len(list(filter(None, want.split(","))))
    assert sum(r.n_added for r in got.values()) >= 8


#: Sentences with the text to be added, or none; no context of these stands in the book.
HELD_OUT = [
    ("please charge my mastercard card no 5500 0000 0000 0005 today", "5500 0000 0000 0005"),
    ("paying by visa 4012-8888-8888-1882, expiry soon", "4012-8888-8888-1882"),
    ("export SECRET_KEY: \"wJalrXUtnFEMI7K7MDENGbPxRfiCYzz9\" done", "wJalrXUtnFEMI7K7MDENGbPxRfiCYzz9"),
    ("his bearer token: 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b here", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"),
    ("then set api_token=Zx81bQ72mmPq45Lr90TyUv33 and go", "Zx81bQ72mmPq45Lr90TyUv33"),
    ("you can reach anna.k[at]firma.de any time", "anna.k[at]firma.de"),
    ("dial the telephone (415) 555-0132 after noon", "(415) 555-0132"),
    ("your phone is 415-555-0132 right", "415-555-0132"),
    ("the server 2001:db8:85a3:8d3:1319:8a2e:370:7348 went down", "2001:db8:85a3:8d3:1319:8a2e:370:7348"),
    ("the order 5500000000000005 has shipped", None),
    ("fixed by commit 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b yesterday", None),
    ("the file checksum 9f86d081884c7d659a2feaa0c55ad015 is right", None),
    ("between 1914 and 1918 some 20 000 000 people", None),
    ("on 2024-05-01 at 12.30 we met 17 of them", None),
    ("release version 300.12.999.4 of the build", None),
    ("a number such as 2123465659789241 in passing", None),
    ("tracking 123456789012345678901234 is on its way", None),
    ("see https://example.org/a1b2c3d4e5f6g7h8i9 for more", None),
    ("he scored 12 of 14 with 300 left", None),
]


def test_trees_decide_unseen_sentences(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HELD_OUT)], "doc_id long, text string")
    right = 0
    for r in pii.personal_data_digest(docs).collect():
        text, want = HELD_OUT[r.doc_id]
        found = [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        if want is None:
            assert found == [], text
        right += found == ([want] if want else [])
    assert right >= 0.9 * len(HELD_OUT)


def test_result_does_not_depend_on_the_rest(spark):
    text = 'token = "11acdfb36bb72224148e6160f674b4be45601bff"'
    alone = spark.createDataFrame([(1, text)], "doc_id long, text string")
    many = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string")
    spans = {r.spans for r in pii.personal_data_digest(alone).union(pii.personal_data_digest(many)).collect()}
    assert spans == {"secret:9:49"}
    assert pii.redacted(alone).collect()[0].text == 'token = "[SECRET]"'
