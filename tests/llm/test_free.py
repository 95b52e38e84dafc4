"""Suffix arrays, quality, decontamination, HTML, SimHash and mixing."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from assayflow.llm import budget, covering, decontaminate, layout, quality, suffixes
from assayflow.llm.common import components
from tests.llm.conftest import sentence

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- components ---

def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(7, None), (8, 8)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- repeated passages ---

def _passages(rows, least=suffixes.LEAST):
    texts = [(i, (text or "").split()) for i, text in rows]
    seen = Counter(tuple(w[k:k + least]) for _, w in texts for k in range(len(w) - least + 1))
    return [(i, len(w), {x for k in range(len(w) - least + 1) if seen[tuple(w[k:k + least])] > 1 for x in range(k, k + least)}) for i, w in texts]


def test_no_repeated_passage_is_missed(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    strict = {i: (n, words) for i, n, words in _passages(rows)}
    loose = {i: words for i, _, words in _passages(rows, suffixes.GRAM)}
    for r in suffixes.passage_report(docs).collect():
        got = {x for a, b in zip(r["starts"], r["ends"]) for x in range(a, b)}
        assert r["n_words"] == strict[r["doc_id"]][0] and r["n_repeated"] == len(got)
        assert strict[r["doc_id"]][1] <= got <= loose[r["doc_id"]]


def test_shared_passage_is_found_and_cut(spark):
    shared = sentence(1, 70)
    rows = [(i, f"{sentence(10 + i, 30 + i)} {shared}\n {sentence(60 + i, 25)}") for i in range(30)] + [(99, sentence(5, 200))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in suffixes.passage_report(df).collect()}
    for i in range(30):
        assert (found[i]["starts"], found[i]["ends"]) == ([30 + i], [100 + i])
        assert found[i]["n_later"] == (70 if i else 0)
    assert found[99]["n_repeated"] == 0
    cut = {r["doc_id"]: r["text"] for r in suffixes.drop_passages(df).collect()}
    assert cut[0] == rows[0][1] and cut[99] == rows[-1][1] and cut[3] == f"{sentence(13, 33)}\n {sentence(63, 25)}"


def test_a_part_of_a_passage_in_an_earlier_document_cuts_nothing(spark):
    rows = []
    for k in range(12):  # the first holds 40 words of the 80 that the others share, the last one 60 of them
        words = sentence(200 + k, 80).split()
        rows += [(4 * k, " ".join([sentence(300 + k, 30), *words[:40]])), (4 * k + 1, " ".join([sentence(400 + k, 30), *words])),
                 (4 * k + 2, " ".join([sentence(500 + k, 20), *words])), (4 * k + 3, " ".join([*words[:60], sentence(600 + k, 20)]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["n_later"] for r in suffixes.passage_report(df).collect()}
    assert found == {i: (0, 0, 80, 60)[i % 4] for i in range(48)}


def test_a_row_alone_in_a_partition_is_not_its_own_neighbour(spark):
    schema = "id bigint, part bigint, place int, run bigint, n_after int, after binary"
    df = spark.createDataFrame([(1, 1, 0, 5, 16, b"\1" * 64)], schema)
    assert [r["ext"] for r in suffixes._extents(df, "after", 4).collect() if r["ext"] >= 0] == []


def test_passages_of_odd_documents(odd_docs, no_docs):
    found = suffixes.passage_report(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_id[1]["n_repeated"] == 60 and by_id[2]["n_later"] == 60 and by_id[3]["n_words"] == 0 and by_id[8]["n_words"] == 1
    assert by_id[7]["n_repeated"] == 60000 and by_id[7]["n_later"] == 0
    left = suffixes.drop_passages(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() and left.where("doc_id = 2").first()["text"] == ""
    assert suffixes.passage_report(no_docs).count() == 0


# --- quality ---

def test_quality_is_learned(spark):
    rng = np.random.default_rng(4)
    good, bad = [f"word{i}" for i in range(200)], [f"W{i}!!" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        junk = i % 3 == 0
        rows.append((i, " ".join(rng.choice(bad if junk else good, 60)), "x"))
        labels.append((i, 0 if junk else 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    found = quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")))
    held = [r for r in found.withColumn("held", quality.held_out(F.col("doc_id"))).where("held").collect()]
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in held]) > 0.98 and len(held) > 150


def test_held_out_labels_are_not_used(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.fit(docs, x) for x in (labels, flipped))
    assert all(np.array_equal(a, b) for a, b in zip(one.layers, two.layers))


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (6, 0), (9, None), (None, 1), (10, 1), (10, 0), (7, 3)], "doc_id bigint, quality int")
    model = quality.fit(odd_docs, labels)
    found = quality.score(odd_docs, model)
    assert found.count() == odd_docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.keep_good(odd_docs, labels, threshold=0.0).columns == odd_docs.columns
    assert 0 <= quality.score(odd_docs, quality.fit(odd_docs, labels.where("false"))).first()["score"] <= 1
    assert quality.score(no_docs, quality.fit(no_docs, labels)).count() == 0


# --- decontamination ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _contaminated(rows, items, window=10):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            windows.setdefault(tuple(words[i:i + width]), set()).update([] if item is None else [str(item)])  # an item without an id hits, too
    widths, result = {len(w) for w in windows}, []
    for i, text in rows:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for width in widths:
            for k in range(len(words) - width + 1):
                if (items_of := windows.get(tuple(words[k:k + width]))) is not None:
                    hit |= set(range(k, k + width))
                    found |= items_of
        result.append((str(i), len(words), len(hit), sorted(found)))
    return sorted(result)


@pytest.mark.parametrize("block", [1 << 24, 2000])
def test_matches_against_all_windows(spark, docs, sf_dir, block):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    given = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    extra = spark.createDataFrame([(900, "Short item"), (901, None), (902, ""), (903, rows[5][1][:300]), (None, "nothing here"), (None, " ".join(rows[9][1].split()[:14])), (904, "the")], "item_id bigint, text string")
    items = given.union(extra)
    found = decontaminate.find_matches(docs, items, block_bytes=block).withColumn("n_hit", decontaminate.hit_words())
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"])) for r in found.collect())
    assert got == _contaminated(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    whole = found.where("doc_id = %d" % rows[5][0]).first()
    assert whole["longest"] >= len(WORD.findall(rows[5][1][:300])) - 1


def test_decontamination_of_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, sentence(1, 12)), (2, None)], "item_id bigint, text string")
    left = decontaminate.drop_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and left.where("doc_id in (1, 2)").count() == 0 and left.count() == odd_docs.count() - 3
    assert decontaminate.drop_contaminated(odd_docs, items.where("false")).count() == odd_docs.count()
    assert decontaminate.drop_contaminated(no_docs, items).count() == 0


# --- HTML ---

@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br/><br>c", "a\nb\n\nc"), ("<b>x</b> <i>y</i>", "x y"), ("a\n  b", "a b"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"), ("<ol start=4><li>a<li>b</ol>", "4. a\n5. b"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"), ("<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>", "wide one\na  b"),
    ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a   b\n\nin"), ("<pre>  a\n    b</pre>", "  a\n    b"), ("x<script>a<b></script>y<style>z</style>", "xy"),
    ("<div hidden>no</div>yes<div style='Display : none'><p>no</p></div>", "yes"), ("<head><title>t</title></head><body>b", "b"), ("a<!-- <p>no -->b", "ab"),
    ("&lt;p&gt; &amp;amp;", "<p> &amp;"), ("1 < 2 <3", "1 < 2 <3"), ("<p title='>'>q</p>", "q"), ("<dl><dt>t<dd>d</dl>", "t\nd"), ("<p>a</div>b", "ab"),
    ("<!doctype html>x", "x"), ("<select><option>a</select>b", "b"), ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"), ("<td>a</td></table>b", "ab"),
    ("<textarea><b></textarea>", "<b>"), ("<p>one</p>\n<p>two</p>", "one\n\ntwo"), ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"), ("<img alt=pic>", "pic"), ("<a", "<a")])
def test_rendering(page, text):
    assert layout.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><p>text<p>more", "text\n\nmore"), ("<head><meta charset=utf-8>\n text", "text"), ("<head><title>t</title><link rel=x><div>a</div></head>b", "a\nb"),
    ("<head><head><title>t</title></head>b", "b"), ("<head><noscript><img alt=no></noscript><template><p>no</template><style>no</style><h1>a", "a"), ("a<head>b", "ab"),
    ("<head><br>a", "a"), ("<head><base href=x><img alt=pic>", "pic"),
    ("a<svg><title>no</title><desc>no</desc>no<text>x <tspan>y</tspan></text><g/><defs><text>no</text></defs><text>z</text></svg>b", "a\nx y\nz\nb"),
    ("a<svg/>b", "ab"), ("<svg><defs/><text>x</text></svg>", "x"), ("<div hidden><svg><text>no</text></svg></div>a", "a"),
    ("<svg><style/><text>x</text></svg>y", "x\ny"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "x=2")])
def test_implied_heads_and_drawn_text(page, text):
    assert layout.render(page) == text


def test_deep_and_long_pages():
    assert layout.render("<div>" * 20000 + "x" + "</div>" * 20000) == "x"
    assert layout.render("<b>" * 5000 + "x<p>y" * 5000).count("y") == 5000
    assert layout.render("<" * 20000 + "'" * 1000).startswith("<<<")


def test_all_visible_words_of_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = layout.extract(pages.withColumn("text", F.lit(1)))
    assert found.columns == ["page_id", "url", "html", "text"]
    for r in found.collect():
        body = re.sub(r"<(script|style|title)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", r["html"], flags=re.S)
        assert Counter("".join(layout.html.unescape(body).split())) - Counter("".join(r["text"].split())) == Counter()
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "<p>\0</p>")], "page_id bigint, html string")
    assert [r["text"] for r in layout.extract(odd).collect()] == ["", "", "", ""]


# --- SimHash ---

def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    width = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_docs):
    for r in odd_docs.where("n_chars is null or n_chars < 5000").collect():
        assert covering.fingerprint((r["text"] or "").encode()) == _fingerprint(r["text"])


@pytest.mark.parametrize("turn", [0, 1, 2])
def test_every_pair_within_the_radius_collides(turn):
    tables = covering.masks(4, turn)
    rng = np.random.default_rng(turn)
    assert len(tables) == 31
    for _ in range(4000):
        far = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(far & m == 0 for m in tables)


@pytest.mark.parametrize("block", [4096, 8, 2])
def test_links_against_all_pairs(spark, block):
    rng = np.random.default_rng(9)
    points = {0}
    for centre in [0, *rng.integers(0, 1 << 62, 12).tolist()]:
        for _ in range(40):
            points.add(centre ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(0, 9)), replace=False)))
    points = np.array(sorted(points), np.int64)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    label = np.arange(len(points))
    for _ in range(len(points)):
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(p),) for p in points], "fp bigint")
    found = {r["node"]: r["component"] for r in components(covering.links(df, 4, block)).collect()}
    assert [found.get(int(p), int(p)) for p in points] == points[label].tolist()


def test_one_row_of_each_component_stays(spark):
    """Also where rows repeat, and where all ids of a component are missing."""
    text = sentence(31, 4000)
    near = [text + " " + sentence(32 + k, 1) for k in range(3)]
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (None, near[2]), (7, sentence(40, 50)), (7, sentence(40, 50)), (8, sentence(40, 50)), (9, sentence(41, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    components = {r["fp"]: r["component_id"] for r in covering.near_duplicates(df).collect()}
    left = covering.drop_near_duplicates(df).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0] * (len(left) - 2) + [7, 9]
    groups = {covering.fingerprint(t.encode()) for t in near}
    linked = len(groups) == 1 or all(bin(a ^ b).count("1") <= 4 for a in groups for b in groups)
    assert linked and len(left) == 3 and len(components) == len(groups) + 2


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    found = covering.near_duplicates(odd_docs)
    assert found.columns == ["doc_id", "fp", "component_id"] and found.count() == odd_docs.count()
    by_id = {r["doc_id"]: r["component_id"] for r in found.where("doc_id is not null").collect()}
    assert by_id[2] == 1 and by_id[3] == by_id[4] == by_id[5] == 3 and by_id[6] == 6 and by_id[7] == 7
    assert {r["component_id"] for r in found.where("doc_id is null").collect()} == {3, 6}
    left = covering.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 3, 6, 7, 8, 9, 10]
    assert covering.near_duplicates(no_docs).count() == 0 and covering.drop_near_duplicates(no_docs).count() == 0


# --- mixing ---

def test_targets():
    assert budget.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 500 / 3, 250 / 3])
    assert budget.targets([], []) == [] and budget.targets([0, 0], [5, 2]) == [0, 0]
    sizes = np.random.default_rng(2).integers(0, 1000, 30).tolist()
    found = budget.targets(sizes, [(5, 2, 1)[i % 3] for i in range(30)])
    assert sum(found) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s + 1e-9 for t, s in zip(found, sizes))


@pytest.mark.parametrize("seed", range(6))
def test_knapsack_against_all_sums(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 40), 6, replace=False)) * int(rng.integers(1, 4))
    counts = rng.integers(1, 5, 6)
    reachable = {0}
    for n, c in zip(lengths.tolist(), counts.tolist()):
        reachable = {s + k * n for s in reachable for k in range(c + 1)}
    for goal in rng.integers(0, int((lengths * counts).sum()) + 1, 20).tolist():
        taken = budget.fit_counts(lengths, counts, goal, seed)
        total = int((taken * lengths).sum())
        assert (taken >= 0).all() and (taken <= counts).all() and total <= goal
        assert total == max(s for s in reachable if s <= goal)


def test_knapsack_of_a_large_source():
    rng = np.random.default_rng(0)
    lengths, counts = np.arange(1, 20000), rng.integers(1, 500, 19999)
    for goal in (123_456_789, 7_777_777_777):
        taken = budget.fit_counts(lengths, counts, goal, 0)
        assert int((taken * lengths).sum()) == goal and (taken <= counts).all() and (taken >= 0).all()


def test_mix_of_the_documents(docs):
    found = budget.mix(docs.repartition(5)).toPandas()
    again = budget.mix(docs.repartition(2)).toPandas()
    key = ["doc_id", "size", "source_size", "target", "copies"]
    assert sorted(map(tuple, found[key].values.tolist())) == sorted(map(tuple, again[key].values.tolist())) and len(found) == docs.count()
    found["taken"] = found["size"] * found["copies"]
    total = found["size"].sum()
    assert (found["taken"] <= 2 * found["size"]).all()
    for _, part in found.groupby("source"):
        assert part["source_size"].iloc[0] == part["size"].sum()
        goal = int(part["target"].iloc[0])
        whole = part["size"].sum()
        rest, sums = goal - goal // whole * whole, {0}
        for size in part["size"].tolist():
            sums |= {s + size for s in sums if s + size <= rest}
        assert part["taken"].sum() == goal // whole * whole + max(sums)
    assert found.groupby("source")["target"].first().sum() == pytest.approx(1.5 * total)


def test_mix_of_odd_documents(odd_docs, no_docs):
    found = budget.mix(odd_docs)
    assert found.count() == odd_docs.count()
    rows = found.collect()
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0} and all(r["copies"] in (0, 1, 2) for r in rows)
    assert {r["source"] for r in rows} == {None, "a"} and sum(r["target"] for r in {r["source"]: r for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    taken = budget.take_mix(odd_docs)
    assert taken.columns == [*odd_docs.columns, "copies"] and taken.where("copies < 1").count() == 0
    assert budget.mix(no_docs).count() == 0 and budget.take_mix(no_docs).count() == 0


def test_hot_lengths_are_split_exactly(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    found = budget.mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert all(0 <= r["target"] - r["taken"] < 3 for r in found)


def test_mix_shuffles_no_text_and_counts_ties(spark):
    """Many rows of one null id and length tie; of every length as many are taken as the plan says, on any partitioning."""
    rows = [(None if i % 3 else i, "a b c" if i % 2 else "a b c d e", "st"[i % 5 == 0]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = []
    for n in (2, 7):
        got = budget.mix(df.repartition(n)).groupBy("source", "size").agg(F.sum("copies").alias("copies"), F.max("target").alias("target"), F.count("*").alias("n")).collect()
        sums.append(sorted((r["source"], r["size"], r["copies"], r["n"]) for r in got))
        for source in "st":
            some = [r for r in got if r["source"] == source]
            assert abs(sum(r["size"] * r["copies"] for r in some) - some[0]["target"]) < 5
    assert sums[0] == sums[1] and sum(r[3] for r in sums[0]) == 900
    plan = budget.take_mix(df)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning(source" in line and "size" in line]
    assert len(exchanged) <= 1  # only rows that tie at the end of a length
