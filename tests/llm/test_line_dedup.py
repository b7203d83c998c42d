"""Line dedup against a plain count in Python."""

import random

from gridmart.llm import line_dedup as D

WS = " \t\n\x0b\x0c\r"


def plain(rows, min_docs, min_chars=1):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))

    seen = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen.setdefault(key(line), set()).add(i)
    gone = {k for k, ids in seen.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if key(x) not in gone]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, *args):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, hash int, copy string")
    return sorted([tuple(r) for r in D.drop_common_lines(df, *args).collect()], key=str)


def test_random_tables(spark):
    rnd = random.Random(4)
    pool = ["Home", " home\t", "ABOUT us", "about us", "É", "é", "", "  ", "\x0b", "x", "x\r", "unique"]
    rows = [(i, "\n".join(rnd.choice(pool) + rnd.choice(["", "", str(rnd.randrange(300))])
                          for _ in range(rnd.randrange(1, 9)))) for i in range(120)]
    for args in ((10,), (10, 5), (1, 1), (10_000,)):
        assert run(spark, rows, *args) == plain(rows, *args)


def test_edge_rows(spark):
    long = "\n".join(["menu", "body"] * 30_000)
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "menu"), (None, "menu\nown"), (4, "Menu \nown words"),
            (4, "Menu \nown words"), (4, "other\nmenu"), (5, long), (6, "a\nMENU"), (7, "menu"), (7, "menu")]
    assert run(spark, rows, 4) == plain(rows, 4)   # 4, 5, 6, 7 and the null id
    assert run(spark, rows, 6) == plain(rows, 6)   # copies of an id count once: nothing goes
    assert run(spark, rows[:0], 3) == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted([tuple(r) for r in D.drop_common_lines(docs, 10).collect()], key=str)
    assert got == plain(rows, 10)
