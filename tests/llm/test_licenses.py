"""Licence notices: odd rows, and every block against every template."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import licenses as L
from tidemark.llm.common import prepare, stored

SCHEMA = "doc_id long, text string, labels int, words string, block int, row string"


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    words = plain(text)
    places, base = [], set()
    for phrase, label in L.PHRASES.items():
        spelled = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(spelled)] == spelled]
        places += found
        base |= {label} if found else set()
    met, best = set(), 0.0
    for _, (label, notice) in templates.items():
        own = set(plain(notice))
        length = L.block_words(len(plain(notice)))
        for start in range(0, max(0, len(words) - length // 2 - 1) + 1, length // 2):
            shared = len(own & set(words[start : start + length]))
            if shared >= L.least_shared(len(own), threshold):
                met.add(label)
                best = max(best, shared / len(own))
    score = 1.0 if places else best
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | met)), score)


def sample_texts():
    draw = random.Random(11)
    noise = ["the", "software", "of", "license", "version", "under", "mit", "general", "public", "x1", "é", "Permission"]
    notices = [text for _, text in L.TEMPLATES.values()]
    texts = [" ".join(draw.choice(noise) for _ in range(draw.randrange(1, 90))) for _ in range(25)]
    for notice in notices:
        words = notice.split()
        texts.append(" ".join(["before"] * draw.randrange(200)) + " " + notice.upper() + "\n" + "after " * 20)
        texts.append(" ".join(w for i, w in enumerate(words) if i % 9))  # one in nine is lacking
        texts.append(" ".join(w for i, w in enumerate(words) if i % 30 != 5))
        texts.append(" pad ".join(words))
        shuffled = words[:]
        draw.shuffle(shuffled)
        texts.append(" ".join(shuffled))
    texts += ["MIT License MIT-License mit license", "General Public License.", "the apache\x00license", "MIT Lıcense", "mit licenses"]
    texts += ["", None, " \t\n ", "...", "日本 mit license 語", " ".join(["mit license"] * 3000)]
    texts.append(" ".join(draw.choice(["lorem", "ipsum", "the", "of"]) for _ in range(30000)) + " " + notices[5])
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "w", 2, "r") for i, t in enumerate(sample_texts())]
    rows += [(3, "released under the mit license", 1, "w", 2, "r")] * 2 + [(None, None, 1, "w", 2, "r"), (None, "MIT License", None, None, None, None)]
    return stored(prepare(spark).createDataFrame(rows, SCHEMA).repartition(4), "license-docs")


def test_labels(docs):
    found = L.license_labels(docs).drop("text_key").collect()
    want = Counter((r.doc_id, *brute(r.text)) for r in docs.collect())
    assert Counter(map(tuple, found)) == want
    assert {label for r in found for label in r.labels.split(",")} == {"", *(label for label, _ in L.TEMPLATES.values())}


def test_matches_at_a_lower_threshold(docs):
    templates = {"one": ("one", "alpha beta gamma delta"), "two": ("two", " ".join(f"x{i}" for i in range(20))), **L.TEMPLATES}
    found = L.license_matches(docs, templates, 0.5).collect()
    want = Counter()
    for row in docs.select("doc_id", "text").distinct().collect():
        words = plain(row.text)
        for name, (_, notice) in templates.items():
            own, length = set(plain(notice)), L.block_words(len(plain(notice)))
            for start in range(0, max(0, len(words) - length // 2 - 1) + 1, length // 2):
                shared = len(own & set(words[start : start + length]))
                if shared >= L.least_shared(len(own), 0.5):
                    want[row.doc_id, name, start, shared] += 1
    assert len(want) > 50
    assert set((r.doc_id, r["name"], r.start, r.shared) for r in found) == set(want)


def test_columns_pass(docs):
    out = L.with_licenses(docs)
    assert out.columns == [*[c for c in docs.columns if c != "labels"], *L.ADDED]
    assert out.count() == docs.count()
    assert Counter((r.doc_id, r.text, r.words, r.block) for r in out.collect()) == Counter(
        (r.doc_id, r.text, r.words, r.block) for r in docs.collect()
    )


def test_empty_table(docs):
    assert L.license_labels(docs.limit(0)).count() == 0
    assert L.with_licenses(docs.limit(0)).count() == 0


def test_plan_has_no_python(docs):
    plan = L.license_labels(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Cartesian" not in plan
