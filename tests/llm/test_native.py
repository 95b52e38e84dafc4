"""URL rules, exact duplicates, repeated lines and rotated dialogues."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from assayflow.llm import exact, lines, rotation, urls
from tests.llm.conftest import sentence


def _similar(a, b):
    return len(a & b) >= lines.THRESHOLD * len(a | b)


def _shingles(line):
    """One shingle at every character; a shorter line is one."""
    return {line[i:i + lines.SHINGLE] for i in range(max(len(line) - lines.SHINGLE, 0) + 1)}


def _lines_by_hand(rows):
    """Places to drop, by comparing all lines that share a shingle."""
    first = {}
    for i, text in rows:
        for place, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" "):
                key = (i is None, i, place)
                first[line.strip(" ")] = min(first.get(line.strip(" "), key), key)
    names = sorted(first)
    sets, parent, holders = [_shingles(x) for x in names], list(range(len(names))), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, shingles in enumerate(sets):
        for j in {k for s in shingles for k in holders.get(s, ())}:
            if _similar(shingles, sets[j]):
                parent[find(i)] = find(j)
        for s in shingles:
            holders.setdefault(s, []).append(i)
    head = {}
    for i, line in enumerate(names):
        head[find(i)] = min(head.get(find(i), first[line]), first[line])
    place_of = {line: head[find(i)] for i, line in enumerate(names)}
    return {(i, place) for i, text in rows for place, line in enumerate(text.split("\n") if text is not None else [])
            if line.strip(" ") and place_of[line.strip(" ")] != (i is None, i, place)}


def test_repeated_lines_against_all_pairs(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = _lines_by_hand(rows)
    found = lines.line_report(docs).collect()
    got = {(r["doc_id"], place) for r in found for place in r["dropped"]}
    assert got <= want and len(want - got) <= 0.005 * len(want)  # banding may miss a pair
    assert len(found) == len(rows) and all(r["n_dropped"] == len(r["dropped"]) for r in found)
    left = {r["doc_id"]: r["text"] for r in lines.drop_lines(docs).collect()}
    for i, text in rows:
        assert left[i] == "\n".join(x for place, x in enumerate(text.split("\n")) if (i, place) not in got)


def test_similar_lines_keep_the_first(spark):
    base = sentence(5, 60)
    rows = [(i, f"own {i} {sentence(100 + i, 12)}\n{base} tail{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r["doc_id"], tuple(r["dropped"])) for r in lines.line_report(df).collect()} == {(0, ())} | {(i, (1,)) for i in range(1, 40)}


def test_lines_of_odd_documents(odd_docs, no_docs):
    found = lines.line_report(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["n_lines"], r["n_dropped"]))
    assert by_id[1] == [(1, 0)] and by_id[2] == [(1, 1)] * 2 and by_id[3] == [(0, 0)] and by_id[4] == [(1, 0)] and by_id[5] == [(3, 0)]
    assert by_id[6] == [(1, 0)] and sorted(by_id[None]) == [(0, 0), (1, 1)]
    assert by_id[7] == [(1500, 1450)]
    left = lines.drop_lines(odd_docs, length="n_chars")
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    assert {r["n_chars"] for r in left.where("doc_id = 2").collect()} == {0} and left.where("doc_id = 3").first()["text"] is None
    assert lines.line_report(no_docs).count() == 0 and lines.drop_lines(no_docs).count() == 0


def test_open_buckets_hand_on_few_pairs_below_the_threshold(spark):
    """Copies of one line at 0.7 to 0.78 share a bucket: nearly all of their pairs are ruled out before texts are met, alike ones never."""
    dice = random.Random(3)
    base = "".join(dice.choices("abcdefghijklmnop ", k=400)).strip()

    def changed(line, n):
        letters = list(line)
        for i in dice.sample(range(len(line)), n):
            letters[i] = letters[i].upper() + "!"
        return "".join(letters)

    texts = [changed(base, 6) for _ in range(60)]
    texts += [changed(x, 2) for x in texts[:6]] + [x[:200] * 3 for x in texts[:6]]
    found = lines.occurrences(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "text", "doc_id")
    keyed = lines.cut_lineage(lines.bands(found))
    ends = keyed.agg(F.min("h").alias("low"), F.max("h").alias("high"))
    members = keyed.crossJoin(ends).select(F.lit(1).cast("long").alias("band"), "h", "low", "high", "bits", "most")
    groups = spark.createDataFrame([], "node bigint, component bigint")
    met = {(r["a"], r["b"]) for r in lines._open_pairs(members, groups, found).collect()}
    low, high = ends.first()
    sets = sorted((r["h"], _shingles(r["line"])) for r in found.select("h", "line").distinct().collect() if r["h"] not in (low, high))
    alike = {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1:] if _similar(x, y)}
    assert alike and alike <= met and len(met) - len(alike) < 0.05 * len(sets) * (len(sets) - 1) / 2
    few = members.where(F.col("h").isin(low, high, sets[0][0]))  # with two leaders no pair is left
    assert lines._open_pairs(few, groups, found).isEmpty()


def _exact_by_hand(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    result = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        result.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(result, key=str)


def test_exact_duplicates(spark, odd_docs, no_docs, tmp_path):
    odd_docs.repartition(3).write.parquet(str(tmp_path / "odd"))
    found = exact.exact_duplicates(spark, str(tmp_path / "odd"))
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == _exact_by_hand(rows)
    no_docs.write.parquet(str(tmp_path / "none"))
    assert exact.exact_duplicates(spark, str(tmp_path / "none")).count() == 0


def test_memory_goes_on_where_it_stopped(spark, tmp_path):
    path, memory = str(tmp_path / "in"), str(tmp_path / "memory")
    for part in ([(1, "a"), (2, "b")], [(3, "a"), (4, "c")]):
        spark.createDataFrame(part, "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(path)
        exact.remember(spark.readStream.schema("doc_id bigint, text string").parquet(path), memory)
    state = {(r["keep_id"], r["group_size"]) for r in exact.recall(spark, memory).collect()}
    assert state == {(3, 2), (2, 1), (4, 1)}


def test_equal_digests_of_different_bytes_are_told_apart(spark):
    schema = "id bigint, digest string, keep_id bigint, group_size bigint, other binary"
    compared = spark.createDataFrame([(1, "d", 5, 4, b"x"), (2, "d", 5, 4, b"x"), (4, "d", 5, 4, None), (5, "d", 5, 4, None), (7, "e", 7, 2, None)], schema)
    assert {tuple(r) for r in exact._regrouped(compared).collect()} == {(1, "d", 2, 2), (2, "d", 2, 2), (4, "d", 5, 2), (5, "d", 5, 2), (7, "e", 7, 2)}


ADDRESSES = [(1, "http://www.Example.com/en/a"), (2, "https://m.example.com/en/9?x=1#y"), (3, "http://a.net/es/"), (4, "http://net/fr/x"),
             (5, None), (6, "no scheme"), (7, "http://"), (8, "http://host.org"), (9, "x://y://z/q"), (9, "x://y://z/q"), (10, "http://notexample.com/en/"),
             (11, "http://a.com"), (12, "http://a.com?b=/en/"), (None, "http://b.net/en/")]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "k", "v") for i, u in ADDRESSES], "page_id bigint, url string, host string, tokens string")
    found = urls.judge(df)
    assert found.columns == ["page_id", "url", "tokens", "host", "path", "rule", "verdict"] and found.count() == len(ADDRESSES)
    by_id = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    assert by_id[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert by_id[2] == ("m.example.com", "/en/9", "example.com/en/", "block")
    assert by_id[3][2:] == ("net/es/", "block") and by_id[4][2:] == ("net/fr/", "block")
    assert by_id[5][:3] == ("", "", None) and by_id[6][:3] == ("", "", None) and by_id[7][:2] == ("", "")
    assert by_id[9][:2] == ("y:", "//z/q") and by_id[10][2:] == ("com/", "allow")
    assert by_id[11][:3] == ("a.com", "", None) and by_id[12][:3] == ("a.com", "", None)
    assert urls.judge(df.where("false")).count() == 0


def test_mined_rules_decide(spark):
    rows = [(i, f"http://good{i % 5}.com/{'shop' if i % 2 else 'news'}/{i}") for i in range(100)]
    rows += [(100 + i, f"http://bad{i % 3}.net/es/casino/{i}") for i in range(40)]
    rows += [(200, "http://new.org/casino/1"), (201, "http://new.org/shop/1"), (202, "http://new.org/other")]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert found[200] == "block" and found[201] == "allow" and found[202] == "allow"


def test_rotation(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", None), (2, 0, None, "x"), (None, 0, "ann", "y"),
            (3, 0, "system", "only"), (4, None, "ann", "t"), (4, 300, "ann", "u"), (5, 1, "bob", "same"), (5, 1, "bob", "same"), (5, 1, "ann", "same")]
    df = spark.createDataFrame([(*r, "b", "s") for r in rows], "conv_id bigint, turn bigint, role string, text string, block string, speaker string")
    found = {(r["conv_id"], r["speaker"], r["block"]): r for r in rotation.rotate(df).collect()}
    assert set(found) == {(1, "ann", 0), (1, "bob", 0), (2, "unknown", 0), (None, "ann", 0), (4, "ann", 0), (5, "ann", 0), (5, "bob", 0)}
    shown = found[1, "ann", 0]
    assert shown["text"] == "<|system|>\nrules<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nhello<|end|>\n<|assistant|>\n<|end|>\n"
    assert [shown["text"][m["start"]:m["end"]] for m in shown["mask"]] == ["hi<|end|>", "<|end|>"]
    assert found[5, "bob", 0]["n_turns"] == 3 and len(found[5, "bob", 0]["mask"]) == 2
    assert rotation.rotate(df.where("false")).count() == 0


def _whole_dialogue(rows, speaker):
    """The unbounded rendering, and what the speaker says."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    heads = {speaker: "<|assistant|>", "system": "<|system|>"}
    return "".join(f"{heads.get(role, f'<|user name={role}|>')}\n{text}<|end|>\n" for _, role, text in ordered), [t for _, role, t in ordered if role == speaker]


@pytest.mark.parametrize("number, turns, characters", [
    (lambda i: i, 1000, 1 << 20), (lambda i: 1000 * i, 600, 400), (lambda i: 7, 600, 1 << 20), (lambda i: None, 255, 1 << 20), (lambda i: i, 1, 1 << 20)])
def test_blocks_join_to_the_whole_dialogue(spark, number, turns, characters):
    """Dense, sparse, equal and missing numbers; blocks by turns and by size. A later block begins with the system turn in force."""
    given = [(number(i), "ab"[i % 2], f"{i:04d} said") for i in range(turns)]
    given += [(number(k), "system", f"rule {k}") for k in (0, turns // 2)]
    df = spark.createDataFrame([(1, *r) for r in given], "conv_id long, turn long, role string, text string").repartition(5)
    found = rotation.rotate(df, characters=characters).where("speaker = 'a'").orderBy("block").collect()
    whole, said = _whole_dialogue(given, "a")
    assert sum(r["n_turns"] for r in found) == len(given) and all(r["n_turns"] <= rotation.BLOCK for r in found)
    assert [r["block"] for r in found] == [sum(x["n_turns"] for x in found[:i]) for i in range(len(found))]
    assert [r["text"][m["start"]:m["end"]].removesuffix("<|end|>") for r in found for m in r["mask"]] == said
    joined = ""
    for r in found:
        if r["text"].count("<|end|>") > r["n_turns"]:
            head, rest = r["text"].split("<|end|>\n", 1)
            assert head.startswith("<|system|>\n") and joined.rfind(head) == joined.rfind("<|system|>")
        else:
            rest = r["text"]
        joined += rest
    assert joined == whole
    assert max(len(r["text"]) for r in found) < 1 << 20


def _all_shingles(line):
    return {line[i:i + 5] for i in range(max(len(line) - 4, 1))}


def _components_by_hand(texts):
    """The first of each component, by comparing all pairs of lines."""
    sets, head = [_all_shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if head[i] != head[j] and _similar(sets[i], sets[j]):
                old, new = max(head[i], head[j]), min(head[i], head[j])
                head = [new if h == old else h for h in head]
    return head


def _dropped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"] for r in lines.line_report(df).collect() if r["dropped"]}


def test_shingles_start_at_every_character(spark):
    texts = ["abcd", "a", "abcdefg", "日本語のテキスト", "x😀yz😀w"]
    found = spark.createDataFrame(enumerate(texts), "i bigint, line string").select("i", F.size(lines.shingles(F.col("line"))).alias("n")).collect()
    assert {r["i"]: r["n"] for r in found} == {i: len(_all_shingles(t)) for i, t in enumerate(texts)}


def test_one_changed_character_still_links(spark):
    words = "several measured values were taken from the second table again twice"
    blankless = "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(120))
    texts = [words, words.replace("second", "sebond"), blankless, blankless[:3] + "新" + blankless[3:], blankless + sentence(8, 12)]
    assert _dropped(spark, texts) == {i for i, h in enumerate(_components_by_hand(texts)) if h != i} == {1, 3}


def test_clusters_beside_the_leaders_are_linked(spark, monkeypatch):
    """All lines in one bucket: clusters without a leader, and chains that hang together through their middle members."""
    real = lines.bands
    monkeypatch.setattr(lines, "bands", lambda given: real(given).withColumn("bands", F.array(F.lit(1).cast("long"))))
    texts = [sentence(c, 20) + f" {v}" for c in range(12) for v in range(4)]
    chain = sentence(77, 40)
    texts += [chain[k * 8:k * 8 + 150] for k in range(12)]
    want = {i for i, h in enumerate(_components_by_hand(texts)) if h != i}
    assert _dropped(spark, texts) == want and len(want) == 12 * 3 + 11
