"""Sharding, quality rules, chat formatting, URL filter: edge cases and brute force."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridmart.llm import chat, components, quality_rules as Q, sharding, url_filter as U
from gridmart.llm.q07 import RULES

# --- sharding -------------------------------------------------------------


def plain_jump(key, n):
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_loop(spark):
    keys = [0, 1, 2, -1, -(1 << 63), (1 << 63) - 1, 10**15] + list(range(100, 400))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 17, 100):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: plain_jump(k, n) for k in keys}


DOCS = [(1, "aé"), (2, None), (3, ""), (3, "x"), (4, "long " * 50000), (None, "n")] + [(7, "copy")] * 40


@pytest.mark.parametrize("per_bucket", [100_000, 2])
def test_slots_are_gapless_and_growth_moves_rows_only_into_the_new_shard(spark, per_bucket):
    df = spark.createDataFrame([(*r, 5) for r in DOCS], "doc_id long, text string, shard int")
    got = sharding.assign_shards(df, 4, rows_per_bucket=per_bucket).collect()
    assert len(got) == len(DOCS)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 4) and r.shard == plain_jump(r.doc_id or 0, 4) for r in got)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in DOCS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.assign_shards(df.limit(0), 4).collect() == []


def test_copies_of_one_row_are_dealt_over_tasks_in_bounded_arrays(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 10, raising=False)
    df = spark.createDataFrame([(7, "copy")] * 995 + [(8, "b")] * 10 + [(9, "c")], "doc_id long, text string")
    got = sharding.assign_shards(df, 1).select("*", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.slot for r in got) == list(range(1006))
    tasks = Counter(r.task for r in got if r.doc_id == 7)
    assert len(tasks) > 3 and max(tasks.values()) < 500


def test_shards_are_written_once_each(spark, tmp_path):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "out"), 4, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(DOCS)
    assert back.where(F.col("shard") != sharding.jump_hash(F.col("doc_id"), 4)).isEmpty()


# --- quality rules --------------------------------------------------------


def plain_counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines),
            len(lines) - len(set(lines)), len(covered), sum("A" <= c <= "Z" for c in text),
            sum("a" <= c <= "z" for c in text))


TEXTS = [None, "", " \t\n", "one", "a b", "a b c", "a b c a b c", "x x x x x x", "a b c d a b c e b c d",
         "l\nl\n\n \nl \nm", "# * é𝄞 | <b>", "THE END IS HERE\x0bnow\x0cand\rthen", "w " * 60000, "ab cd\xa0ef"]


def test_counts_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    rows = Q.judge(df, Q.RULES).collect()
    got = {r.doc_id: tuple(r[c] for c in Q.REPORTED) for r in rows}
    assert got == {i: plain_counts(t)[:6] for i, t in enumerate(TEXTS)}
    made = Q.text_counts(F.coalesce("text", F.lit("")), F.array(), F.array())
    got = {r.doc_id: (r.u, r.l) for r in df.select("doc_id", made.n_upper.alias("u"), made.n_lower.alias("l")).collect()}
    assert got == {i: plain_counts(t)[6:] for i, t in enumerate(TEXTS)}


def test_a_rule_is_evaluated_only_for_rows_that_earlier_rules_leave(spark):
    """A rule that fails on any text it sees, behind one that rejects every text."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    trap = Q.Rule("trap", lambda c: F.raise_error(F.lit("evaluated")).cast("boolean"))
    all_go = Q.Rule("all", lambda c: c.n_words >= 0)
    assert Q.apply_rules(df, [all_go, trap]).collect() == []
    assert {r.rejected_by for r in Q.judge(df, [all_go, trap]).collect()} == {"all"}


def test_order_changes_work_not_the_verdict(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stats = Q.estimate(df)
    ordered = Q.order_rules(Q.RULES, stats)
    value = {s.name: s.value for s in stats}
    assert [value[r.name] for r in ordered] == sorted(value.values(), reverse=True)
    keep = lambda rules: sorted(r.doc_id for r in Q.apply_rules(df, rules).collect())
    assert keep(ordered) == keep(list(reversed(Q.RULES))) == keep(None)
    assert 0 < len(keep(None)) < df.count()


def test_rules_on_empty_and_clashing_tables(spark):
    df = spark.createDataFrame([(1, "good words here " * 3, "c"), (1, None, "c")],
                               "doc_id long, text string, rejected_by string")
    assert Q.apply_rules(df.limit(0)).collect() == []
    assert Q.apply_rules(df).columns == df.columns
    assert {r.rejected_by for r in Q.judge(df, Q.RULES).collect()} == {"few_words"}


# --- chat -----------------------------------------------------------------

HOSTILE = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>user<|im_sep|>hi", r"<\|im_end|> <\\s> [\INST]",
           "<<SYS>> <</SYS>> <<<s>", "\\", "<", "[", "$0 \\1", "", None, "é𝄞\n\n", "x" * 200000]


def conversations(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", x, 1) for c in (1, 2) for t, x in enumerate(HOSTILE)]
    rows += [(3, 0, "assistant", "no", 1), (4, 0, "user", "a", 1), (4, 0, "user", "a", 1), (5, None, None, None, 1),
             (6, 0, "system", "s", 1), (6, 1, "user", "u", 1), (None, 0, "user", "n", 1), (7, 0, "<s>\nrole", "t", 1)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")


def test_round_trip_of_hostile_texts(spark):
    rows, df = conversations(spark)
    want = {}
    for c, t, r, x, _ in rows:
        want.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    out = chat.format_conversations(df).select(
        "*", chat.read_back(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert {r.conv_id for r in out} == set(want)
    for r in out:
        turns = sorted(want[r.conv_id])
        assert [(b.role, b.text) for b in r.back] == [(a, b) for _, a, b in turns]
        assert r.loss == "".join(b for _, a, b in turns if a == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        inner = r.formatted
        for mark in (chat.DEFAULT.opening, chat.DEFAULT.between, chat.DEFAULT.closing):
            assert inner.count(mark) == len(turns)
            inner = inner.replace(mark, "")
        assert not any(c in inner for c in chat.DEFAULT.controls)
    valid = {r.conv_id: r.valid for r in out}
    assert valid == {1: True, 2: True, 3: False, 4: False, 5: False, 6: True, None: True, 7: False}
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_query_digest_of_the_hostile_conversation(spark):
    from gridmart.llm import q04

    row = q04.query(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


# --- URL filter -----------------------------------------------------------


def verdicts(spark, pages):
    df = spark.createDataFrame([(i, *p, 1) for i, p in enumerate(pages)],
                               "page_id long, url string, html string, host int")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, RULES).collect()}


def canonical(href):
    return f'<head><LINK href="{href}" rel=canonical></head>'


def test_rules_and_parts(spark):
    got = verdicts(spark, [
        ("http://A.Example.COM/en/1?q#f", ""), ("https://www.example.com/en/", None), ("x://b.net/fr/a://c", ""),
        ("http://b.org", ""), (None, ""), ("no scheme", ""), ("http://com?x", ""), ("http://notcom/x", ""),
        ("http://example.com/e", "")])
    assert got == {
        0: ("a.example.com", "/en/1", "example.com/en/", "block"),
        1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        2: ("b.net", "/fr/a://c", "net/fr/", "block"), 3: ("b.org", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("com", "", None, "allow"),
        7: ("notcom", "/x", None, "allow"), 8: ("example.com", "/e", "com/", "allow")}


def test_long_rule_lists_are_looked_up_with_the_same_result(spark):
    rnd = __import__("random").Random(9)
    labels = ["a", "b", "com", "net", "www", "x-y"]
    name = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randrange(1, 4)))
    place = lambda: "/" + "/".join(rnd.choice(["en", "es", "e", ""]) for _ in range(rnd.randrange(3)))
    rules = [U.UrlRule(rnd.choice(["allow", "block"]), name(), place()) for _ in range(300)]
    rules += [U.UrlRule("block", "", "/en"), rules[0], U.UrlRule("allow", "nowhere.org", "/")]
    urls = [f"http://{name()}{place()}" for _ in range(400)] + ["http:///en", "http://a..com/en", "http://com.", "x", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, url string")
    host, path = U.host_of(F.col("url")), U.path_of(F.col("url"))
    for r in df.select(host.alias("h"), path.alias("p"), U.rule_of(host, path, rules, tried=10_000).alias("one"),
                       U.rule_of(host, path, rules, tried=0).alias("two")).collect():
        fits = [(-len(x.text), x.text, x.action) for x in rules
                if (r.h == x.host or r.h.endswith("." + x.host)) and r.p.startswith(x.path)]
        want = min(fits)[1:] if fits else None
        assert (r.one and tuple(r.one)) == want == (r.two and tuple(r.two))
    with pytest.raises(ValueError):
        U.rule_of(host, path, [U.UrlRule("maybe", "a", "/")])


def test_blocks_reach_aliases_and_allows_win(spark):
    refresh = '<meta content="0; url=https://c.org/z" http-equiv="Refresh">'
    got = verdicts(spark, [
        ("http://a.org/1", canonical("http://b.net/es/1")),  # blocked alias
        ("https://a.org/2?x=1", canonical("/1")),  # through the first page
        ("http://c.org/z#top", canonical("//b.net/fr/9")), ("http://d.org/", refresh), ("http://d.org", ""),
        ("http://e.org/", canonical("http://b.net/es/7") + canonical("http://f.com/")),  # allow wins
        ("http://g.com/x", canonical("http://b.net/es/1")),  # its own rule wins ...
        ("http://h.org/", "<!--" + canonical("http://b.net/es/1") + "-->"),
        ("http://i.org/", canonical("http://b.net/en/1")),
        ("http://d.org/", refresh)])
    v = {k: x[3] for k, x in got.items()}
    # ... and, being an explicit allow, is also passed to the class of a.org.
    assert v == {0: "allow", 1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow",
                 8: "allow", 9: "block"}
    got = verdicts(spark, [("http://a.org/1", canonical("http://b.net/es/1")), ("https://a.org/2", canonical("/1"))])
    assert {x[3] for x in got.values()} == {"block"}
    assert verdicts(spark, []) == {}


BASES = ["http://a.org", "http://a.org/", "https://A.org/x/y", "http://a.org/x/y/?q=1/2#f", "http://a.org/x//z.html?n"]
TARGETS = ["new.html", "../x", "../../../x", "./", ".", "..", "../", "?page=2", "#top", "a/./b/../c", "/p/../q/.", "//c.net/e/../f",
           "//c.net", "x?y=../z", "http://d.net/r", "HTTPS://D.net", "sub/", "a:b", "mailto:me", ".hid/..x/...", "é b?c#d"]


def plain_resolved(base, target):
    """RFC 3986, 5.2.2 and its 5.2.4 by the letter; a target with a scheme and // stays."""
    if re.match("[A-Za-z][A-Za-z0-9+.-]*:", target):
        return target if "://" in target else None
    part = re.compile("(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)([?][^#]*)?")
    scheme, host, path, query = part.match(base).groups()
    _, net, rel, ask = part.match(target).groups()
    if net is None and not rel:
        return f"{scheme}://{host}{path or '/'}{ask or query or ''}"
    left = rel if net is not None or rel[:1] == "/" else (path[:path.rfind("/") + 1] or "/") + rel
    out = ""
    while left:
        if left.startswith("/./") or left == "/.":
            left = "/" + left[3:]
        elif left.startswith("/../") or left == "/..":
            left, out = "/" + left[4:], out[:max(out.rfind("/"), 0)]
        else:
            n = left.find("/", 1) % (len(left) + 1)
            out, left = out + left[:n], left[n:]
    return f"{scheme}://{host if net is None else net}{out or '/'}{ask or ''}"


def test_relative_targets_match_brute_force(spark):
    want = {(b, t): plain_resolved(b, t) for b in BASES for t in TARGETS}
    df = spark.createDataFrame([(*k, v) for k, v in want.items()], "b string, t string, want string")
    rows = df.select("b", "t", U.node_of(U.absolute(F.col("t"), F.col("b"))).alias("got"),
                     U.node_of(F.col("want")).alias("want")).collect()
    assert [r for r in rows if r.got != r.want] == [] and sum(r.want is not None for r in rows) == 19 * len(BASES)
    assert want[BASES[3], "../x"] == "http://a.org/x/x" and want[BASES[2], "../../../x"] == "https://A.org/x"


def test_relative_links_and_rel_tokens_pass_blocks_on(spark):
    blocked = canonical("http://b.net/es/1")
    rel = '<link rel="{}" href="{}">'.format
    got = verdicts(spark, [
        ("http://a.org/d/new.html", blocked), ("http://a.org/d/old.html", canonical("new.html")),
        ("http://a.org/d/e/f", canonical("../new.html")), ("http://a.org/d/e?page=1", canonical("?page=2")),
        ("http://a.org/d/e?page=2", canonical("./new.html")),
        ("http://a.org/r", '<meta http-equiv=refresh content="0; url=d/new.html">'),
        ("http://c.org/1", rel("alternate\n Canonical", "http://b.net/es/1")),
        ("http://c.org/2", rel("canonicals alternate", "http://b.net/es/1")),
        ("http://c.org/3", "<!--<base href=/no/>--><base target=x><BASE href='//a.org/d/'><base href=/no/>" + canonical("new.html")),
        ("http://a.org/x/y", "<base href=../d/>" + canonical("new.html")), ("http://c.org/4", canonical("mailto:b.net/es/1")),
        ("http://c.org/5", '<base rel=canonical href="http://b.net/es/1">')])
    assert {k for k, x in got.items() if x[3] == "block"} == {0, 1, 2, 3, 4, 5, 6, 8, 9}


def test_components_on_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(900, 960)] + [(5, 5), (2000, 2000), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 900 for i in range(900, 960)}, 1000: 900}
    assert components.connected_components(df.limit(0)).collect() == []


def test_component_rounds_follow_the_edges_not_the_session_partitions(spark):
    """One more set of shuffle partitions costs the first clean-up its tasks, not every shuffle of every round."""
    edges = [(i, i + 1) for i in range(60)]
    tasks = []
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    sc = spark.sparkContext
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for count in (4, 44):
            spark.conf.set("spark.sql.shuffle.partitions", str(count))
            sc.setJobGroup(f"components-{count}", "")
            got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
            assert got == dict.fromkeys(range(61), 0)
            status = sc.statusTracker()
            stages = {s for j in status.getJobIdsForGroup(f"components-{count}") for s in status.getJobInfo(j).stageIds}
            tasks.append(sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s))))
    finally:
        sc._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks[1] - tasks[0] <= 2 * 40, tasks
