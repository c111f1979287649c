import random

import numpy as np
import pytest

from larkspire.llm.line_dedup import GroupStream, dedup_lines
from tests.llm.helpers import documents, rows


def brute(texts, min_docs, min_chars=1, keep_first=False):
    blanks = " \t\n\x0b\f\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keys = {i: [x.strip(blanks).translate(low) for x in (t or "").split("\n")] for i, t in texts}
    found = {}
    for i in sorted(keys):
        for n, k in enumerate(keys[i]):
            found.setdefault(k, []).append((i, n))
    drop = set()
    for k, places in found.items():
        if len(k) >= min_chars and len({i for i, _ in places}) >= min_docs:
            drop.update(places[1:] if keep_first else places)
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if (i, n) not in drop]
        out.append((i, len(lines), len(lines) - len(kept), t if len(kept) == len(lines) else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
def test_matches_brute_force(spark, keep_first):
    random.seed(5)
    texts = [(i, "\n".join(random.choice(["A line", "a LINE ", "b", "", " ", "\tlong é line", f"own {i}", f"x{random.randrange(40)}"]) for _ in range(random.randrange(12)))) for i in range(300)]
    texts += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "Ä\nä\n\x1c")]
    for min_docs in (1, 2, 10, 150):
        out = dedup_lines(documents(spark, texts), min_docs, keep_first=keep_first)
        assert rows(out, "doc_id", "n_lines", "n_dropped", "text") == brute(texts, min_docs, keep_first=keep_first)


def test_edges(spark):
    assert dedup_lines(documents(spark, [])).count() == 0
    repeated = documents(spark, [(1, "a\nb")] * 12 + [(None, "a\nc"), (None, None)])
    out = dedup_lines(repeated, 3)  # rows that repeat are one document
    assert sorted(out.columns) == sorted([*repeated.columns, "n_lines", "n_dropped"])
    assert {(r.doc_id, r.text, r.n_dropped) for r in out.collect()} == {(1, "a\nb", 0), (None, "a\nc", 0), (None, None, 0)}
    clash = documents(spark, ["x\ny", "x\nz"]).selectExpr("*", "1 AS did", "2 AS pos", "3 AS n_lines", "4 AS h1")
    assert rows(dedup_lines(clash, 2), "doc_id", "text", "did", "n_lines") == [(0, "y", 1, 2), (1, "z", 1, 2)]


def test_rows_of_one_id_are_one_document(spark):
    texts = [(1, f"a\nb{i}") for i in range(6)] + [(2, "a\nc")] + [(None, f"q\nr{i}") for i in range(3)]
    docs = documents(spark, texts)
    assert {r.n_dropped for r in dedup_lines(docs, 3).where("doc_id IS NOT NULL").collect()} == {0}
    assert [r.text for r in dedup_lines(docs, 3).where("doc_id IS NULL").orderBy("text").collect()] == ["r0", "r1", "r2"]
    assert rows(dedup_lines(docs, 2).where("doc_id IS NOT NULL"), "doc_id", "text") == [(1, f"b{i}") for i in range(6)] + [(2, "c")]


def test_very_long_texts(spark):
    long = "\n".join("same" if i % 3 else f"own line {i}" for i in range(300_000))
    texts = [(1, long), (2, "x" * 3_000_000 + "\nsame"), (3, "same\nlast")]
    assert rows(dedup_lines(documents(spark, texts), 3), "doc_id", "n_lines", "n_dropped", "text") == brute(texts, 3)


@pytest.mark.parametrize("keep_first", [False, True])
def test_stream_says_the_same_for_any_cut(keep_first):
    random.seed(3)
    for _ in range(60):
        table = sorted({(random.randrange(5), 0, random.randrange(8), random.randrange(2), random.randrange(3)) for _ in range(random.randrange(1, 60))})
        table = np.array(table)
        least = random.randrange(1, 6)
        want = set()
        for k in set(table[:, 0]):
            group = [tuple(map(int, r)) for r in table if r[0] == k]
            if len({r[2] for r in group}) >= least:
                want.update(group[1:] if keep_first else group)
        cuts = sorted(random.sample(range(len(table) + 1), min(3, len(table))))
        # partitions never cut a document of a line
        cuts = [c for c in cuts if 0 < c < len(table) and (table[c][[0, 2]] != table[c - 1][[0, 2]]).any()]
        said = []
        for part in np.split(table, cuts):
            stream = GroupStream(least, keep_first)
            for batch in np.split(part, sorted(random.sample(range(len(part) + 1), min(4, len(part))))):
                if len(batch):
                    said += stream.feed(batch)
            said += stream._end_group(True)
        said = np.concatenate(said) if said else np.zeros((0, 7), int)
        got = [tuple(map(int, r[1:6])) for r in said if r[0] == 0]
        totals, firsts = {}, {}
        for r in said[said[:, 0] == 2]:
            totals[r[1]] = totals.get(r[1], 0) + r[6]
            firsts[r[1]] = min(firsts.get(r[1], (1 << 60,)), tuple(map(int, r[3:6])))
        for r in said[said[:, 0] == 1]:
            if totals[r[1]] >= least and not (keep_first and tuple(map(int, r[3:6])) == firsts[r[1]]):
                got.append(tuple(map(int, r[1:6])))
        assert len(got) == len(set(got)) and set(got) == want
