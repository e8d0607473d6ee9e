import random
import re

from cabstand.llm import credentials
from tests.llm.support import clashing, odd_rows, prose, table

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return [(credentials.KINDS[k], s, e) for s, k, e in sorted(found)]


def key(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def secret_rows():
    rng = random.Random(6)
    hexa, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    rows = odd_rows()
    for i in range(120):
        body = prose(700 + i, 30)
        found = [f'token = "{key(rng, hexa, 40)}"', f"password={key(rng, hexa, 18)}", f"AKIA{key(rng, upper, 16)}"][i % 3]
        rows.append((1000 + i, f"é{body} {found} {body} mail{i}.example.com/path-to-page", "en", "a", 1))
    for i in range(150):
        body = f"{prose(900 + i, 20)} on 2023-04-{i % 28:02d}T12.30.45 Mail{i}.Example.COM/Page-{i * 7919}.HTML"
        rows.append((1500 + i, body, "en", "a", 1))
    rows.append((2000, "PASSWD: 'abc=secret=abcdefghijklmnop' ſecret=abcdefghijklmnop\nAPIKEY:short api_key=0123456789ab", "en", "a", 1))
    return rows, rng


def test_patterns_and_inferred_formats(spark):
    rows, rng = secret_rows()
    strange = "-".join(key(rng, "0123456789abcdef", 12) for _ in range(4))
    rows.append((3000, f"plain words, then {strange} and ordinarywordswithoutnumbers", "en", "a", 1))
    docs = clashing(table(spark, rows)).drop("found")
    found = credentials.scanned(docs, credentials.infer_formats(docs)).collect()
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in found}
    for r in rows:
        assert [s for s in spans[r[0]] if s[0] != "inferred"] == brute(r[1])
    assert [s[0] for s in spans[3000]] == ["inferred"]
    assert not [i for i, s in spans.items() if i != 3000 and any(k == "inferred" for k, _, _ in s)]


def test_held_out_accuracy():
    rng = random.Random(7)
    hexa = [key(rng, "0123456789abcdef", rng.choice([18, 40])) for _ in range(600)]
    plain = [f"{key(rng, 'abcdefghijklmnoprstuvwz', rng.randint(9, 14))}.example.com" for _ in range(400)]
    formats = credentials.Formats({"hex": credentials.Automaton(hexa[:300])}, credentials.Ordinary(plain[:200]), 0.0)
    assert sum(map(formats.accepts, hexa[300:])) >= 294 and not any(map(formats.accepts, plain[200:]))


def test_states_merge_where_they_agree():
    rng = random.Random(9)
    dashed = ["0a0-" * min(40, int(rng.expovariate(0.3)) + 1) + "0a0" for _ in range(400)]
    automaton = credentials.Automaton(dashed)
    assert len(automaton.rules) < 12 < len(set(dashed)) * 4
    assert automaton.score(credentials.classed(dashed[0])) > automaton.score(credentials.classed("zz-00-AA-zz-00"))


def test_without_labels_and_empty(spark):
    docs = table(spark, [(1, "nothing to see", "en", "a", 1), (2, None, "en", "a", 1)])
    assert [r.found for r in credentials.scanned(docs, credentials.infer_formats(docs)).collect()] == [[], []]
    empty = table(spark, [])
    assert credentials.scanned(empty, credentials.infer_formats(empty)).count() == 0
