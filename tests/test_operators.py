"""Operators on small fixtures, against plain Python."""

import itertools
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.functions.similarity import aligned_span, window_ratio
from storyloom.graph import connected_components
from storyloom.operators import entities, mining, patterns, quality, repair, requests, segment, sequence, verify
from storyloom.sources import readers
from storyloom.streaming import monitors


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_raw_text_to_units(spark, tmp_path):
    raw = "\r\n".join(["『书名/作者:某某』", "『状态:完结』", "『内容简介:开头", "继续", "ixdzs.com", "------章节内容开始-------", "第1章 甲", "第2章 乙", "　　正文一。", "", "　　第2章 乙", "请点击下一页", "第4章 丙", "　　正文二。", "ixdzs 推广", ""])
    (tmp_path / "a.txt").write_bytes(raw.encode("gb18030"))
    lines = readers.read_lines(spark, str(tmp_path)).cache()
    head = readers.parse_header(lines).first()
    assert (head.title, head.author, head.declared_status, head.blurb, head.source_note, head.body_start) == ("书名", "某某", "完结", "开头继续", "ixdzs.com", 6)
    end = readers.body_end(lines).first().body_end
    assert end == 14
    body = lines.where((F.col("line_no") >= 6) & (F.col("line_no") < end))
    units = segment.units(segment.classify_lines(body, segment.is_title(F.col("text")))).orderBy("seq").collect()
    assert [(u.seq, u.chapter_id, u.declared_num, u.title, u.is_merged, u.paragraphs) for u in units] == [(1, "ch0001", 1, "甲", True, ["正文一。"]), (2, "ch0002", 4, "丙", False, ["正文二。"])]
    assert [s.kind for s in units[0].stripped_lines] == ["dup title", "inserted"]
    assert units[0].merged_titles[0].declared_num == 2


def test_numbers(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (5,), (3_000_000,)], "n int")
    found = segment.number_health(df, "n")
    assert found.where("kind = 'duplicate'").first().number == 2
    assert found.where("kind = 'missing'").count() == 3_000_000 - 4


def test_text_functions(spark):
    assert value(spark, T.normalized(F.lit("“Ａ，b　c”…"))) == '"A,bc"...'
    assert value(spark, T.json_block(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert value(spark, T.json_block(F.lit("none"))) is None
    assert value(spark, T.duration(F.lit(3661))) == "1:01:01"
    assert value(spark, T.terms(F.lit("a，b; c"))) == ["a", "b", "c"]
    assert value(spark, T.display_width(F.lit("中a"))) == 3
    assert [value(spark, T.is_speech(F.lit(x))) for x in ("凡人", "好！", "这是七个字的话", None)] == [False, True, True, False]


def test_quote_checks(spark):
    paras = spark.createDataFrame([(1, 1, "他说：“今天的天气真好啊！”"), (1, 2, "她笑了笑，没有回答这个问题。")], "seq int, para int, text string")
    cases = [(1, 1, "今天的天气真好啊！", "exact", 1, True), (2, 1, "今天的天气真好啊!", "exact", 1, True), (3, 1, "没有回答这个问题", "exact", 2, False), (4, 2, "她笑了笑,没有回答这一个问题", "near", None, None), (5, 1, "飞机在云层上方盘旋", "miss", None, None), (6, 1, "", "empty", None, None), (7, None, "好啊！”她笑了笑", "exact", -1, None)]
    quotes = spark.createDataFrame([(c[0], 1, c[1], c[2]) for c in cases], "qid int, seq int, para int, quote string")
    found = {r.qid: (r.status, r.para_found, r.para_correct) for r in verify.check_quotes(quotes, paras).collect()}
    assert found == {c[0]: c[3:] for c in cases}
    report = verify.unit_report(verify.check_quotes(quotes.where("qid IN (1, 5)"), paras)).first()
    assert report.verbatim_rate == 0.5 and report.miss == 1


def test_coverage(spark):
    paras = spark.createDataFrame([(1, 1, "“今天的天气真好啊！”"), (1, 2, "“凡人”不懂“我们快点走吧！”")], "seq int, para int, text string")
    given = spark.createDataFrame([(1, 1, "今天的天气真好啊！")], "seq int, para int, quote string")
    r = verify.coverage(paras, given).first()
    assert (r.speech, r.covered, r.missed) == (2, 1, ["我们快点走吧！"])
    assert repair.missing_dialogue(paras, given).first().text == "我们快点走吧！"


def test_repair(spark):
    paras = spark.createDataFrame([(1, 1, "“第一句话。”他说，“第二句话。”"), (1, 2, "“第三句话。”"), (1, 3, "原文以姚安饶此时的神情最为平静。")], "seq int, para int, text string")
    quotes = spark.createDataFrame([(1, 1, 1, "dialogues", "第一句话。第二句话。"), (2, 1, 1, "dialogues", "第二句话。第三句话。"), (3, 1, 3, "narration.x", "以姚安恕此时的神情最为平静。"), (4, 1, 1, "narration.x", "完全无关的另外一些文字内容")], "qid int, seq int, para int, field string, quote string")
    found = {r.qid: (r.kind, [p.text for p in r.parts] if r.parts else None) for r in repair.repair(quotes, paras).collect()}
    assert found[1] == ("joined", ["第一句话。", "第二句话。"])
    assert found[2] == ("across paragraphs", ["第二句话。", "第三句话。"])
    assert found[3][0] == "aligned" and found[3][1][0] in "原文以姚安饶此时的神情最为平静。" and "姚安饶" in found[3][1][0]
    assert found[4] == (None, None)
    old = spark.createDataFrame([(1, 0.9, 1), (2, 0.5, 2)], "seq int, verbatim_rate double, miss int")
    new = spark.createDataFrame([(1, 0.8, 1), (2, 0.9, 1)], "seq int, verbatim_rate double, miss int")
    assert {r.seq: r.keep for r in repair.rolled_back(old, new).collect()} == {1: "old", 2: "new"}


def test_similarity():
    assert window_ratio("abcdefgh", "xxabcdXefghxx") > 0.7
    assert window_ratio("", "abc") == 0
    assert aligned_span("abcdefgh", "zzzz")[1] is None


def test_gate_and_generic(spark):
    df = spark.createDataFrame([(1, 90, 95, 1.0, 0), (2, None, 95, 0.9, 0), (3, 90, 95, 1.0, 2)], "seq int, structure_score int, fidelity_score int, verbatim_rate double, miss int")
    assert [(r.passed, r.tier) for r in quality.tiers(quality.gate(df)).orderBy("seq").collect()] == [(True, "T3"), (False, "T2"), (False, "T1")]
    assert [value(spark, quality.generic_name(F.lit(x))) for x in ("众人", "护卫甲", "唐真", "")] == [True, True, False, True]
    assert [value(spark, entities.generic(F.lit(x))) for x in ("小丫头", "唐真", "客人（群体）")] == [True, False, True]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    parent = list(range(60))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    for few in (0, 1000):
        found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()}
        assert found == {n: root(n) for n in {x for a, b in edges if a != b for x in (a, b)}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), few=9).count() == 0


def replay(edges, principals):
    """(name -> root, rejected edges), edges in order: curated ones always join, others unless both sides hold a principal."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    chief, rejected = {n: True for n in principals}, []
    for a, b, verified in edges:
        x, y = root(a), root(b)
        if x != y and not verified and chief.get(x) and chief.get(y):
            rejected.append((a, b))
        elif x != y:
            parent[y] = x
            chief[x] = chief.get(x) or chief.get(y)
    return {n: root(n) for n in parent}, rejected


@pytest.mark.parametrize("names, many, principal, few, curated", [(30, 40, 2, 1000, [("n1", "n2")]), (60, 90, 2, 0, [("n1", "n2"), ("n2", "n3"), ("n5", "n9")]), (40, 200, 6, 5, []), (12, 60, 4, 3, [("n0", "n1")]), (50, 20, 99, 0, [])])
def test_guarded_merge_equals_one_replay(spark, names, many, principal, few, curated):
    """Two principals stay apart unless curated, whether edges are finished in one task or not."""
    rng = random.Random(names)
    rows = [(i, rng.randrange(2), f"n{rng.randrange(names)}", [f"n{rng.randrange(names)}" for _ in range(rng.randrange(1, 3))]) for i in range(many)]
    mentions = spark.createDataFrame(rows, "seq long, pos long, name string, aliases array<string>")
    counts = mentions.groupBy("name").agg(F.count("*").alias("n"), F.min("seq").alias("first_ord"))
    edges = entities.alias_edges(mentions, spark.createDataFrame(curated, "a string, b string"))
    clusters, rejected = entities.guarded_merge(edges, counts, principal=principal, few=few)
    whole = edges.select("a", "b", "verified", "ord.*").toPandas().sort_values(["verified", "seq", "pos", "alias_pos", "a", "b"], ascending=[False, True, True, True, True, True])
    roots, rejects = replay(zip(whole.a, whole.b, whole.verified, strict=True), {r.name for r in counts.where(F.col("n") >= principal).collect()})
    groups = lambda pairs: sorted(sorted(n for n, _ in g) for _, g in itertools.groupby(sorted(pairs, key=lambda x: x[1]), key=lambda x: x[1]))
    found = [(r.name, r.cluster) for r in clusters.collect()]
    assert groups(found) == groups(roots.items()) and all(c == min(n for n, d in found if d == c) for _, c in found)
    assert sorted((r.a, r.b) for r in rejected.collect()) == sorted(set(rejects))
    canonical = {r.name: r.canonical for r in entities.canonical_names(clusters, counts).collect()}
    n = {r.name: (r.n, len(r.name)) for r in counts.collect()}
    for group in groups(found):
        assert {n.get(canonical[x], (0, len(canonical[x]))) for x in group} == {max(n.get(y, (0, len(y))) for y in group)} and len({canonical[x] for x in group}) == 1


def test_guarded_merge_of_no_edges(spark):
    none = spark.createDataFrame([], "seq long, pos long, name string, aliases array<string>")
    clusters, rejected = entities.guarded_merge(entities.alias_edges(none), none.groupBy("name").agg(F.count("*").alias("n")))
    assert clusters.count() == 0 and rejected.count() == 0


def test_resolver_levels(spark):
    index = spark.createDataFrame([("甲", ["a", "b"]), ("乙", ["b", "甲"]), ("丙", [])], "canonical string, aliases array<string>")
    names = spark.createDataFrame([(x,) for x in ("a", "b", "甲", "丙", "zz", "vip", "no")], "name string")
    found = {r.name: (r.owner, r.doubt) for r in entities.resolve(names, index, spark.createDataFrame([("vip", "甲")], "name string, owner string"), spark.createDataFrame([("no",)], "name string")).collect()}
    assert found == {"a": ("甲", False), "b": ("b", True), "甲": ("甲", True), "丙": ("丙", False), "zz": ("zz", False), "vip": ("甲", False), "no": ("no", True)}


def best_cuts(change, cost, lo, hi):
    n, best = len(change), None

    def walk(at, total, cuts):
        nonlocal best
        if at == n:
            if best is None or total > best[0] + 1e-12:
                best = (total, cuts)
            return
        for k in range(lo, hi + 1):
            if at + k <= n:
                walk(at + k, total + (0 if at + k == n else change[at + k - 1] - cost), [*cuts, at + k])

    walk(0, 0.0, [])
    return best


def plain_cuts(change, cost, lo, hi):
    """Ends of the best segments by one pass over all of them; costs in units of 1e-9."""
    n = len(change)
    gain = [round((c - cost) * 1e9) for c in change[:-1]] + [0]
    best, back = [0] + [None] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        options = [(best[b], -b) for b in range(max(0, end - hi), end - lo + 1) if best[b] is not None]
        if options:
            most, begin = max(options)
            best[end], back[end] = most + gain[end - 1], -begin
    cuts, at = [], n if n and best[n] is not None else 0
    while at:
        cuts.append(at)
        at = back[at]
    return cuts[::-1]


def test_plain_cuts_against_all_choices():
    rng = random.Random(3)
    for _ in range(20):
        change = [rng.random() for _ in range(12)]
        cuts = plain_cuts(change, 0.5, 2, 5)
        assert abs(sum(change[c - 1] - 0.5 for c in cuts[:-1]) - best_cuts(change, 0.5, 2, 5)[0]) < 1e-9


@pytest.mark.parametrize("block, lo, hi", [(1024, 10, 50), (64, 3, 9), (9, 3, 9), (16, 1, 4)])
def test_change_points_in_blocks_equal_one_pass(spark, block, lo, hi):
    rng = random.Random(block)
    groups = {"long": 700, "short": 5, "none": 2, "odd": 33, "even": 64}
    change = {g: [rng.choice([0.0, 0.25, 0.5, rng.random()]) for _ in range(n)] for g, n in groups.items()}  # with ties
    curve = spark.createDataFrame([(g, i + 1, c) for g, x in change.items() for i, c in enumerate(x)] + [(None, 1, 0.5)], "grp string, pos long, change double")
    out = sequence.change_points(curve.repartition(5), cost=0.4, shortest=lo, longest=hi, block=block).collect()
    for g, x in change.items():
        own = sorted((r.cut, r.start) for r in out if r.grp == g and r.feasible)
        cuts = plain_cuts(x, 0.4, lo, hi)
        assert [c for c, _ in own] == cuts and [s for _, s in own] == [1, *(c + 1 for c in cuts[:-1])][: len(cuts)]
        assert bool(cuts) != any(r.grp == g and not r.feasible for r in out)
    assert sequence.change_points(curve.limit(0)).count() == 0


def test_segments_in_blocks_equal_one_pass(spark):
    rng = random.Random(8)
    sizes = {"a": 900, "b": 40, "c": 1, "d": 13}
    units = spark.createDataFrame([(g, i, rng.choice([4.0, 5.5, 7.0, 9.3])) for g, n in sizes.items() for i in range(1, n + 1)], "grp string, pos long, minutes double")
    kinds = spark.createDataFrame([("a", i, rng.choice(["hard", "soft"])) for i in range(7, 900, 11)], "grp string, pos long, kind string")
    candidates = sequence.segment_candidates(units, kinds).cache()
    found = {block: sorted(map(tuple, sequence.budgeted_segments(candidates, units, block=block).collect()), key=str) for block in (1024, 5, 32)}
    assert found[1024] == found[5] == found[32]
    rows = defaultdict(list)
    for r in candidates.collect():
        rows[r.grp, r.stop].append((r.start, round(r.cost * 1e6)))
    for g, n in sizes.items():
        best = {0: 0}
        for stop in range(1, n + 1):
            options = [best[s - 1] + c for s, c in rows[g, stop] if s - 1 in best]
            if options:
                best[stop] = min(options)
        own = sorted(r for r in found[32] if r[0] == g and r[-1])
        cost = {(r.grp, r.start, r.stop): round(r.cost * 1e6) for r in candidates.collect()}
        assert (n in best) == bool(own) and sum(cost[g, r[2], r[3]] for r in own) == best.get(n, 0)
        assert [r[1] for r in own] == list(range(1, len(own) + 1)) and [r[2] for r in own] == [1, *(r[3] + 1 for r in own[:-1])][: len(own)]


def test_chains_have_no_python_in_their_plans(spark):
    units = spark.createDataFrame([("g", i, 7.0) for i in range(1, 41)], "grp string, pos long, minutes double")
    out = sequence.budgeted_segments(sequence.segment_candidates(units), units, block=8)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_arcs_name_who_leaves(spark):
    cuts = spark.createDataFrame([("g", 1, 5, True), ("g", 6, 9, True), ("h", None, None, False)], "grp string, start long, cut long, feasible boolean")
    last = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", 7), ("h", "d", 9)], "grp string, name string, last long")
    assert sorted(map(tuple, sequence.arcs(cuts, last).collect())) == [("g", 1, 5, 5, "hard", ["a", "b"]), ("g", 6, 9, 4, "soft", [])]
    assert {(r.cut, tuple(r.exits)) for r in sequence.arcs(cuts).collect()} == {("soft", ())}


def test_segments(spark):
    units = spark.createDataFrame([("g", i, 7.0) for i in range(1, 41)] + [("one", 1, 7.0)], "grp string, pos long, minutes double")
    out = sequence.budgeted_segments(sequence.segment_candidates(units), units).toPandas()
    g = out[out.grp == "g"].sort_values("start")
    assert g.units.tolist() == [4] * 10 and g.start.tolist() == [1, *(g.stop[:-1] + 1)]
    assert not out[out.grp == "one"].feasible.iloc[0]
    hard = spark.createDataFrame([("g", 12, "hard"), ("g", 24, "hard")], "grp string, pos long, kind string")
    cut = sequence.budgeted_segments(sequence.segment_candidates(units.where("grp = 'g'"), hard), units.where("grp = 'g'")).toPandas()
    assert {12, 24} <= set(cut.stop) and not any(a < 12 < b or a < 24 < b for a, b in zip(cut.start - 1, cut.stop, strict=True))


def test_requests(spark):
    good, bad = requests.parse_replies(spark.createDataFrame([('x {"k": 3} y',), ("nothing",), (None,)], "reply string"), "k int")
    assert good.first().parsed.k == 3 and bad.count() == 2


def test_ordinal_is_gapless(spark):
    df = spark.createDataFrame([(random.Random(i).randrange(10**6),) for i in range(200)], "x long")
    assert sorted(r.n for r in readers.with_ordinal(df, "x", "n").collect()) == list(range(1, 201))


def test_streams_equal_batches(spark, tmp_path):
    log = spark.createDataFrame([(f"2024-01-0{1 + i % 3} 0{i % 10}:00:00", i % 4 == 0, i % 3, float(i)) for i in range(60)], "ts string, is_error boolean, attempt int, elapsed double").withColumn("ts", F.to_timestamp("ts"))
    log.write.parquet(str(tmp_path / "log"))
    batch = monitors.call_health(log).collect()
    stream = monitors.call_health(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")))
    q = stream.writeStream.format("memory").queryName("health").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("health").collect()) == sorted(batch)


def test_documents_with_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"seq": 1, "x": "y"}')
    (tmp_path / "b.json").write_text("{broken")
    good, bad = readers.read_documents(spark, str(tmp_path), "seq int, x string")
    assert good.count() == 1 and bad.first().file == "b.json"


def test_ordinal_by_group_is_gapless(spark):
    rows = [(x % 3 if x % 7 else None, x) for x in range(300)]
    found = readers.with_ordinal(spark.createDataFrame(rows, "g long, x long"), "x", "n", "g").collect()
    for g in (0, 1, 2, None):
        assert [r.n for r in sorted(found, key=lambda r: r.x) if r.g == g] == list(range(1, sum(k == g for k, _ in rows) + 1))


def test_registry_against_plain_counts(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(1, 300_000), f"n{int(rng.random() ** 2 * 12)}") for _ in range(400)]
    targets = sorted({rng.randrange(1, 320_000) for _ in range(25)} | {5, 400_000})
    found = {}
    for r in requests.registry_before(spark.createDataFrame(rows, "seq long, name string"), spark.createDataFrame([(t,) for t in targets], "seq long"), most=4).collect():
        found.setdefault(r.target, []).append((r["rank"], r.name, r.n))
    for t in targets:
        n = {}
        for s, name in rows:
            if s < t:
                n[name] = n.get(name, 0) + 1
        want = [(i, name, k) for i, (name, k) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:4], 1)]
        assert sorted(found.get(t, [])) == want


def test_similarity_against_all_windows():
    from difflib import SequenceMatcher

    rng = random.Random(11)
    for _ in range(60):
        source = "".join(rng.choice("abcdef ,.“”") for _ in range(rng.randrange(12, 60)))
        at = rng.randrange(len(source) - 8)
        quote = "".join(c if rng.random() > 0.15 else "z" for c in source[at : at + rng.randrange(6, 20)])
        n = len(quote)
        block = SequenceMatcher(None, quote, source, autojunk=False).find_longest_match(0, n, 0, len(source))
        if block.size and n < len(source):
            places = [p for p in range(len(source) - n + 1) if abs(p - (block.b - block.a)) <= n // 2]
            assert abs(window_ratio(quote, source) - max((SequenceMatcher(None, quote, source[p : p + n]).ratio() for p in places), default=0)) < 1e-12
        score, span, lo = aligned_span(quote, source)
        assert span is None or (span in source and len(span) >= 0.8 * n and score <= 1.1 and span in source[lo:])


def test_curated_tables(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"identities": [{"canonical": "A", "aliases": ["a1", "x"], "ambiguous": ["x"], "exclude": ["A-list"]}], "tags": {"t": ["w", "v"]}}')
    found = readers.curated(spark, str(tmp_path / "c.json"))
    assert {(r.name, r.owner) for r in found["identities"].collect()} == {("A", "A"), ("a1", "A")}
    assert [r.name for r in found["ambiguous"].collect()] == ["x"] and [r.phrase for r in found["excluded"].collect()] == ["A-list"] and found["tags"].count() == 2


def test_small_text_functions(spark):
    assert value(spark, T.slug(F.lit(' a/b "c" with a very long name'))) == "a_b__c__with_a_very_"
    assert value(spark, T.filled(F.array(F.lit(" a "), F.lit(""), F.lit(None), F.lit("　")))) == ["a"]
    assert value(spark, T.filled(F.lit(None).cast("array<string>"))) == []
    assert value(spark, T.without_note(F.lit("name（note）"))) == "name"


def test_assembly(spark):
    from storyloom.operators import assemble

    paras = spark.createDataFrame([(1, 1, "他说：“今天的天气真好啊！”她答：“我们快点走吧！”"), (2, 1, "“这是一句没有人抄下来的话。”")], "seq int, para int, text string")
    refs = spark.createDataFrame([(1, "dialogues", 0, 1, 0, None), (1, "dialogues", 1, 1, 1, None), (2, "narration", 0, 1, None, "没有"), (2, "narration", 1, 9, None, None)], "seq int, field string, pos int, para int, q int, text string")
    quotes, rejects = assemble.expanded(refs, paras)
    assert [r.error for r in rejects.collect()] == ["para out of range"]
    found = {r.seq: (r.total, r.errors, r.coverage_rate, r.passed) for r in assemble.verified(quotes, paras, rejects).collect()}
    assert found == {1: (2, 0, 1.0, True), 2: (1, 1, 0.0, False)}
    assert [[q.text for q in x] for x in assemble.documents(quotes.where("seq = 1")).first().fields.values()] == [["今天的天气真好啊！", "我们快点走吧！"]]


def test_repaired_quotes_are_logged(spark):
    fixed = spark.createDataFrame([(1, 1, "dialogues", "ab", "joined", [("a", 1), ("b", 1)]), (2, 1, "dialogues", "x", None, None)], "qid int, seq int, field string, quote string, kind string, parts array<struct<text: string, para: int>>")
    rates = lambda r: spark.createDataFrame([(1, r, 1.0)], "seq int, verbatim_rate double, coverage_rate double")
    (row,) = repair.repair_log(fixed, rates(0.5), rates(1.0)).collect()
    assert (row.before, row.after, row.rate_before, row.rate_after) == ("ab", ["a", "b"], 0.5, 1.0)


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_pattern_hits_equal_the_alternation(spark, most_bytes):
    rng = random.Random(77)
    words = ["".join(rng.choices("abcé中", k=rng.randint(1, 7))) for _ in range(60)] + ["", "aa", "a", "\U0001f600a"]
    texts = ["".join(rng.choices("abcé中 \U0001f600", k=rng.randint(0, 60))) for _ in range(80)] + [None, "", "aaaaa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "seq long, text string").withColumn("word", F.lit("clash"))
    table = spark.createDataFrame([(w,) for w in [*words, None, "a"]], "word string")
    found = sorted(map(tuple, patterns.pattern_hits(rows, table, most_bytes=most_bytes).collect()))
    one = re.compile("|".join(re.escape(w) for w in sorted(set(words) - {""}, key=lambda w: (-len(w), w))))
    assert found == sorted((i, m.start(), m[0]) for i, t in enumerate(texts) for m in one.finditer(t or ""))
    every = sorted(map(tuple, patterns.pattern_hits(rows, table, overlapping=True, most_bytes=most_bytes).collect()))
    assert every == sorted((i, k, w) for i, t in enumerate(texts) for w in set(words) - {""} for k in range(len(t or "")) if t.startswith(w, k))


def test_a_hundred_thousand_patterns_in_one_pass(spark):
    words = [f"n{i:x}" for i in range(100_000)]
    rows = spark.createDataFrame([(i, f"n{i:x} or n{i * 7 % 100_000:x}z, where") for i in range(200)], "seq long, text string")
    found = {(r.seq, r.word) for r in mining.word_hits(rows, spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert found == {(i, f"n{k:x}") for i in range(200) for k in (i, i * 7 % 100_000)}


def streamed(spark, tmp_path, batches, kind, make, mode):
    """Rows that a streaming query gives for batches one after the other."""
    folder, out = str(tmp_path / "in"), []
    spark.createDataFrame([], kind).write.parquet(folder)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for rows in batches:
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
            got = []
            stream = make(spark.readStream.schema(kind).parquet(folder))
            q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            q.awaitTermination()
            out.append(sorted(map(tuple, got)))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return out


def test_stall_alert_comes_before_the_next_event(spark, tmp_path):
    t = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    batches = [[("a", t(0)), ("b", t(1)), (None, t(2))], [("a", t(5))], [("b", t(24)), ("c", t(24))], [("c", t(60))], [("a", t(61))]]
    out = streamed(spark, tmp_path, batches, "job string, ts timestamp", lambda s: monitors.stall_alerts(s, "job"), "append")
    told = [(k, r[0], (r[1] - t(0)).total_seconds(), r[3]) for k, rows in enumerate(out) for r in rows]
    assert ("a", 5.0, 2) in [x[1:] for x in told] and min(k for k, *x in told if x[0] == "a") < 4  # told before a's next event at 61
    assert not any(x[0] == "b" and x[1] == 1.0 and k < 2 for k, *x in told)


def test_progress_as_a_stream_takes_late_rows(spark, tmp_path):
    t = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    expected = spark.createDataFrame([("j", 20)], "job string, expected long")
    batches = [[("j", t(10), True), ("j", t(20), False)], [("j", t(700), True)], [("j", t(30), True)], [("j", t(20_000), True)], [("j", t(40), True)]]
    out = streamed(spark, tmp_path, batches, "job string, ts timestamp, passed boolean", lambda s: monitors.progress_stream(s, expected), "update")
    assert [[(r[2], r[3], r[4], r[6]) for r in rows] for rows in out[:3]] == [[(2, 1, 1, 10.0)], [(1, 1, 0, 5.0)], [(3, 2, 1, 15.0)]]
    assert [r[2] for r in out[3]] == [1] and out[4] == []  # the first window is closed by then


def test_narration_between_segments_is_stripped(spark):
    paras = spark.createDataFrame([(1, 1, "“我们快走吧，天要黑了。”他低声说，“不然就来不及了，真的。”"), (1, 2, "“没有旁白的一句话而已。”")], "seq long, para int, text string")
    quotes = spark.createDataFrame([(10, 1, 1, "我们快走吧，天要黑了。他低声说，不然就来不及了，真的。"), (11, 1, 2, "没有旁白的一句话而已。他说。"), (12, 1, None, "无关的话")], "qid long, seq long, para int, quote string")
    found = {r.qid: (r.kind, [(p.text, p.para) for p in r.parts]) for r in repair.strip_narration(quotes, repair.segments(paras)).collect()}
    assert found == {10: ("narration", [("我们快走吧，天要黑了。", 1), ("不然就来不及了，真的。", 1)])}


def test_quotes_are_aligned_to_the_span_that_fits_best(spark):
    paras = spark.createDataFrame([(1, 1, "前面的话。他慢慢地走到窗前，看着外面的雨。后面的话。"), (1, 2, "前面的话。她慢慢地走到窗前，看着外面的雪。后面的话。"), (2, 1, "他慢慢地走到窗前，看着外面的雨。")], "seq long, para int, text string")
    quotes = spark.createDataFrame([(1, 1, 2, "他慢慢走到窗前，看着外面的雨。"), (2, 1, None, "完全不同的句子在这里"), (3, 2, 1, "他慢慢地走到窗前，看着外面的雨。")], "qid long, seq long, para int, quote string")
    found = {r.qid: (r.parts[0].text, r.parts[0].para, round(r.score, 4)) for r in repair.align(quotes, paras).collect()}
    assert found == {1: ("他慢慢地走到窗前，看着外面的雨。", 1, round(30 / 31 + 0.1, 4)), 3: ("他慢慢地走到窗前，看着外面的雨。", 1, 1.1)}


def test_clip_counts_columns(spark):
    assert [value(spark, T.clip(F.lit(x), 5)) for x in ("abcdefg", "中文字", "a中文字", "", "abc")] == ["abcde", "中文", "a中文", "", "abc"]


@pytest.mark.parametrize("encoding, part", [("GB18030", "64"), ("GB18030", "1g"), ("UTF-16", "1g"), ("Shift_JIS", "100")])
def test_lines_are_the_same_however_a_file_is_divided(spark, tmp_path, encoding, part):
    rng = random.Random(len(part))
    alphabet = "甲乙丙丁あいう abc0" + ("\U00020000鿿é" if encoding == "GB18030" else "")
    texts = {f"{k}.txt": "".join(rng.choice(["\n", "\r\n", "\r"]) if rng.random() < 0.1 else rng.choice(alphabet) for _ in range(900)) + rng.choice(["", "\n"]) for k in range(3)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.legacy.javaCharsets", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        lines = readers.read_lines(spark, str(tmp_path), encoding).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    for name, text in texts.items():
        plain = text.replace("\r\n", "\n").replace("\r", "\n")
        own = sorted((r.line_no, r.text) for r in lines if r.doc.endswith(name))
        assert own == list(enumerate((plain[:-1] if plain.endswith("\n") else plain).split("\n")))
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_alignment_is_dealt_over_tasks(spark):
    """the step that takes long over few bytes is after a deal that Spark does not join to one task again."""
    q = spark.createDataFrame([(1, 1, 1, "She went to the old mill at dawm.")], "qid long, seq long, para int, quote string")
    p = spark.createDataFrame([(1, 1, "So. She went to the old mill at dawn. Then.")], "seq long, para int, text string")
    found = repair.align(q, p)
    assert 0 <= plan(found).index("ArrowEvalPython") < plan(found).index("REPARTITION_BY_NUM")
    assert found.first()["parts"][0]["text"] == "She went to the old mill at dawn."


def test_joined_quotes_without_a_row_for_each_run(spark):
    """runs of segments are told by the quotes that they begin, not written out for every segment."""
    p = spark.createDataFrame([(1, 1, "Aa b. Cc. Dd."), (1, 2, "Aa b. Cc. Ee.")], "seq long, para int, text string")
    segs = spark.createDataFrame(repair.segments(p, r"([^.]+\.)").collect())
    q = spark.createDataFrame([(1, 1, 2, "Aa b.Cc."), (2, 1, 1, "Dd.Aa b."), (3, 1, 1, "Cc.Ee."), (4, 1, 1, "Cc.")], "qid long, seq long, para int, quote string")
    one, more = repair.split_joined(q, segs), repair.split_across(q, segs)
    assert "Generate" not in plan(one) + plan(more)
    assert {r.qid: [(x.text, x.para) for x in r.parts] for r in one.collect()} == {1: [("Aa b.", 2), ("Cc.", 2)], 3: [("Cc.", 2), ("Ee.", 2)]}
    assert {r.qid: [(x.text, x.para) for x in r.parts] for r in more.collect()} == {2: [("Dd.", 1), ("Aa b.", 2)]}


def test_similarity_of_long_lines_of_frequent_letters():
    """difflib finds only the common beginning of such lines; no window needs to be compared to know that."""
    from storyloom.functions import similarity

    text = "abcde fghij klmno " * 300
    quote = "ab#" + text[3:2000]
    seen = []
    class Counted(similarity.SequenceMatcher):
        def ratio(self):
            seen.append(1)
            return super().ratio()
    plain, similarity.SequenceMatcher = similarity.SequenceMatcher, Counted
    try:
        assert similarity.window_ratio(quote, text) == max(plain(None, quote, text[i : i + 2000]).ratio() for i in range(0, 40))
    finally:
        similarity.SequenceMatcher = plain
    assert len(seen) < 100


def test_hits_of_a_word_do_not_overlap_each_other(spark):
    """a word that begins with its own end is counted as often as it can be taken out."""
    texts = spark.createDataFrame([(1, "the the the the "), (2, "aXaXa aXa")], "seq long, text string")
    words = spark.createDataFrame([("the the ",), ("aXa",)], "word string")
    for most in (patterns.MOST_BYTES, 0):
        hits = patterns.counted_apart(patterns.pattern_hits(texts, words, overlapping=True, most_bytes=most))
        assert sorted(map(tuple, hits.collect())) == [(1, "the the ", 2), (2, "aXa", 2)]


def test_the_next_target_is_found_in_a_growing_frame(spark):
    """a frame that is open at its far end is read anew for every row of a block."""
    from storyloom.operators import requests

    seqs = spark.range(0, 300).withColumnRenamed("id", "seq")
    targets = spark.createDataFrame([(10,), (20,), (250,)], "target long")
    found = requests.following_target(seqs, targets, block=64)
    assert "RangeFrame, 1, unboundedfollowing" not in plan(found)
    assert {r.seq: r.target for r in found.collect()} == {s: min(t for t in (10, 20, 250) if t > s) for s in range(250)}


def test_mutual_aliases_without_a_sort(spark):
    """both directions of a pair meet in one group."""
    index = spark.createDataFrame([("a", ["b", "c", "a"]), ("b", ["a"]), ("ab", ["a"]), ("c", ["b"])], "canonical string, aliases array<string>")
    found = entities.mutual_aliases(index)
    assert "Join" not in plan(found)
    assert [tuple(r) for r in found.collect()] == [("a", "b", False)]


def test_pairs_are_dealt_before_they_are_counted(spark):
    """tasks that count pairs grow in number with the table, not in size."""
    items = spark.createDataFrame([(1, 5), (1, 6), (1, 6), (2, 6), (2, 5), (2, 7)], "seq long, name long")
    found = entities.cooccurrence(items, None)
    assert plan(found).count("REPARTITION_BY_NUM") >= 2
    assert sorted(map(tuple, found.collect())) == [(5, 6, 2), (5, 7, 1), (6, 7, 1)]


def test_cut_histogram_makes_arcs_once(spark, monkeypatch):
    """F8: the segments and their ends come from the same arcs."""
    from storyloom.plans import sequence_queries

    made, arcs = [], sequence_queries._arcs
    monkeypatch.setattr(sequence_queries, "_arcs", lambda *a, **k: made.append(1) or arcs(*a, **k))
    sequence_queries.cut_histogram(spark, "/root/testdata/sf0.001").collect()
    assert made == [1]


def test_opening_marks_are_looked_for_in_linear_time():
    """one character before an opening mark tells what a run of them does."""
    import inspect

    opening = inspect.signature(repair.repair).parameters["opening"].default
    assert "+" not in opening
    for length in range(6):
        for text in map("".join, itertools.product('a“”"', repeat=length)):
            assert bool(re.search(opening, text)) == bool(re.search('^[“"]|[^“”"]+[“"]', text))


def test_quotes_meet_their_unit_once(spark):
    """one join of quotes with units, and only the quotes' own units are grouped; the likely windows are tried before all others."""
    from storyloom.functions import similarity

    paras = spark.createDataFrame([(1, 1, "Aa bb."), (1, 2, "Cc dd."), (1, 3, "Aa bb. Ee"), (1, 4, None), (2, 1, "Zz"), (None, 1, "Aa")], "seq long, para int, text string")
    cases = [(1, 1, 3, "Aa bb.", "exact", 3, True), (2, 1, None, "Aa bb.", "exact", 1, None), (3, 1, 0, "Cc", "exact", 2, None), (4, 1, 1, "bb.Cc", "exact", -1, None), (5, 1, 2, "bb.Ee", "exact", 3, False), (6, 3, 1, "Aa", "miss", None, None), (7, 1, 1, None, "empty", None, None), (8, None, 1, "Aa", "miss", None, None), (9, 1, 1, "Cc ed.Aa", "near", None, None)]
    quotes = spark.createDataFrame([c[:4] for c in cases], "qid long, seq long, para int, quote string")
    found = verify.check_quotes(quotes, paras, norm=T.flat)
    text = plan(found)
    joins = re.findall(r"(\w+Join\w*) (?=\[)", text)
    assert sorted(j for j in joins if j != "BroadcastHashJoin") in ([], ["SortMergeJoin"]) and "LeftSemi, BuildRight" in text and "Union" not in text
    assert found.columns == ["qid", "seq", "para", "quote", "status", "para_found", "para_correct", "similarity"]
    assert {r.qid: (r.seq, r.para, r.quote, r.status, r.para_found, r.para_correct) for r in found.collect()} == {c[0]: c[1:] for c in cases}

    rng = random.Random(5)
    source = "".join(rng.choice("abcdefghij") for _ in range(3000))
    plain, similarity.Spans = similarity.Spans, None
    try:
        for lost in (0, 40, 99):
            quote = source[1000 : 1000 + lost] + source[1001 + lost : 1101]
            assert similarity.window_ratio(quote, source) == 1 if quote in source else 0.98 < similarity.window_ratio(quote, source) < 1
    finally:
        similarity.Spans = plain


def test_change_curve_counts_in_runs_of_units(spark, monkeypatch):
    """occurrences are sent once to each run of units, not to sixteen anchors; tasks hold a bounded number of units."""
    rng = random.Random(3)
    rows = [(g, rng.randrange(1, n + 1), rng.choice("abcdefgh"[:k])) for g, n, k in (("x", 100, 8), ("y", 5, 2), ("z", 64, 3)) for _ in range(3 * n)]
    items = spark.createDataFrame(rows, "grp string, pos int, item string")
    units = spark.createDataFrame([(g, p) for g, n in (("x", 100), ("y", 5), ("z", 64), ("w", 2)) for p in range(1, n + 1)], "grp string, pos int")
    for width, least in ((8, 3), (3, 2), (40, 5)):
        want = {}
        for g, n in (("x", 100), ("y", 5), ("z", 64), ("w", 2)):
            for p in range(1, n + 1):
                count = lambda lo, hi: {i for i in "abcdefgh" if sum(r == (g, q, i) for r in rows for q in [r[1]] if lo <= q <= hi) >= least}  # noqa: B023, E731
                before, after = count(p - width + 1, p), count(p + 1, p + width)
                want[g, p] = 0.0 if p == n or not before | after else 1 - len(before & after) / len(before | after)
        found = {(r.grp, r.pos): r.change for r in sequence.change_curve(items, units, width, least).collect()}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-12 for k in want)
    monkeypatch.setattr(sequence, "UNITS_A_TASK", 10)
    text = plan(sequence.change_curve(items, units))
    assert re.findall(r"REPARTITION_BY_NUM", text) == ["REPARTITION_BY_NUM"] and "hashpartitioning(grp#" in text
    assert re.search(r"hashpartitioning\(grp#\d+, run#\d+L?, 17\), REPARTITION_BY_NUM", text)  # 171 units
    assert not re.search(r"hashpartitioning\([^)]*(item|anchor)#", text)


def test_last_units_of_names_are_counted_in_runs(spark, monkeypatch):
    """a frequent name's units are counted where they are, not in one task."""
    rng = random.Random(4)
    rows = [(g, rng.randrange(1, 700), rng.choice("abcdef")) for g in ("x", "y") for _ in range(400)] + [("x", 3, "rare")] * 50 + [("y", u, "often") for u in range(1, 700)]
    seen = defaultdict(set)
    for g, u, n in rows:
        seen[g, n].add(u)
    units = spark.createDataFrame([(g, u) for g in ("x", "y") for u in range(1, 700)], "grp string, pos int")
    monkeypatch.setattr(sequence, "UNITS_A_TASK", 100)
    found = sequence.last_units(spark.createDataFrame(rows, "grp string, unit int, name string"), units, 15)
    assert plan(found).count(", 13), REPARTITION_BY_NUM") == 2
    assert {(r.grp, r.name): r["last"] for r in found.collect()} == {k: max(v) for k, v in seen.items() if len(v) >= 15}


def test_blocks_of_chains_are_dealt_over_tasks(spark, monkeypatch):
    """blocks and what is made of them are few bytes, which Spark would join to one task."""
    from storyloom.operators import chains

    kept, stored = {}, chains.stored
    monkeypatch.setattr(chains, "stored", lambda df, name, *a, **k: kept.setdefault(name, stored(df, name, *a, **k)))
    rng = random.Random(6)
    curve = spark.createDataFrame([(g, p, rng.random()) for g in "ab" for p in range(1, 301)], "grp string, pos int, change double")
    whole = sorted(map(tuple, sequence.change_points(curve).collect()))
    kept.clear()
    assert sorted(map(tuple, sequence.change_points(curve, block=50).collect())) == whole
    assert len(kept["blocks"].inputFiles()) > 1 and len(kept["chosen"].inputFiles()) > 1
