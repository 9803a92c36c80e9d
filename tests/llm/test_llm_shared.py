"""Line bitmaps, prefix trie and shared search against plain Python versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import line_dedup, packing, prefix_trie, queries, search
from starmill.sources.scratch import written

SPACES = " \t\n\x0b\f\r"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


# --- line bitmaps


def line_documents(seed=2):
    draw = random.Random(seed)
    common = [f"  {word} is a line of more than forty code points É{word}\t" for word in "abcdefgh"]
    short = ["short", "", "   ", "x" * 39]
    texts = []
    for i in range(60):
        own = [draw.choice(common) for _ in range(draw.randint(0, 6))]
        own += [draw.choice(short) for _ in range(draw.randint(0, 3))] + [f"a line that no other document has, number {i} of all"]
        own = [line.upper().replace("É", "é") if draw.random() < 0.2 else line for line in own]
        draw.shuffle(own)
        texts.append("\n".join(own))
    rows = [(i * 7 % 61, t) for i, t in enumerate(texts)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, texts[0]), (None, texts[1]), (5000, texts[3]), (5000, texts[3])]
    rows += [(5000, "another text of the largest id\n" + common[0]), (103, "\n".join([common[1]] * 40)), (104, "y" * 60_000)]
    return [(i, t, "en", "s", None) for i, t in rows]


def plain_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return lower(line.strip(SPACES))

    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add((i, text))
    last = {
        k: max((i for i, _ in held if i is not None), default=None)
        for k, held in holders.items() if len(held) >= min_docs
    }
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in last and last[key(x)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [False, True])
def test_line_bitmaps(spark, heavy, monkeypatch):
    rows = line_documents()
    docs = fixtures.frame(spark, rows)
    if heavy:  # half of the keys take the way of keys with very many lines
        def listed(df, columns):
            return {"a": {r["a"]: 0.1 for r in df.select("a").distinct().collect() if r["a"] % 2 == 0}}
    else:
        def listed(df, columns):
            return {"a": {}}
    monkeypatch.setattr(line_dedup, "heavy_shares", listed)
    marked = line_dedup.keep_bitmaps(docs, keep=("doc_id", "text"))
    text = line_dedup.kept_text(F.col("text"), F.col("kept"), F.col("n_dropped"))
    found = marked.select("doc_id", "n_lines", "n_dropped", text.alias("t"), "kept").collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == plain_lines(rows)
    for r in found:
        assert sum(run["n"] for run in r["kept"]) == r["n_lines"] - r["n_dropped"]
        assert all(a["first"] + a["n"] < b["first"] for a, b in zip(r["kept"], r["kept"][1:]))
    assert any(r["n_dropped"] for r in found)


def test_line_bitmaps_of_nothing_and_of_one_line_everywhere(spark):
    assert line_dedup.keep_bitmaps(fixtures.frame(spark, [])).isEmpty()
    line = "the same line of more than forty code points in all of them"
    rows = [(i, "\n".join([line] * 3), None, None, None) for i in range(400)]
    found = line_dedup.keep_bitmaps(fixtures.frame(spark, rows)).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in found] == [3] * 399 + [0]
    assert found[0]["kept"] == [] and [tuple(x) for x in found[-1]["kept"]] == [(0, 3)]


def test_line_bitmaps_use_no_python_and_move_no_text(spark):
    docs = fixtures.frame(spark, line_documents())
    plan = line_dedup.dropped_lines(
        docs.select(F.col("doc_id").alias("doc"), F.lit(1).alias("copy"), "text")
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning(a" in plan
    assert "text" not in plan


# --- prefix trie


def plain_nodes(paths):
    """Nodes of {conv: turns}."""
    members = defaultdict(list)
    for conv, turns in paths.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves = sum(sums[c][0] for c in children[path]) if children[path] else 1
        sums[path] = leaves, (len(members[path]) - 1) * words + sum(sums[c][1] for c in children[path])
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(path))
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]),
            *sums[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, place int, a int, words int"


def conversation_rows(seed):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-5, 150), 90):
        for turn in range(draw.choice([1, 1, 2, 3, 5, 9, 40])):
            role = draw.choice(["user", None, ""])
            text = draw.choice(["a", "b  c", None, "", " d e\tf "]) if conv % 3 else "same words here"
            rows.append((conv, None if turn == 0 and conv % 4 == 0 else turn, role, text, "x", 1, 2, 3))
    rows += [(None, 1, "user", "none", "x", 1, 2, 3), (-40, 1, "é", "\0 " * 50, "x", 1, 2, 3)]
    draw.shuffle(rows)
    return rows


def rebuilt(rows, borrow=True):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    if not borrow:
        return own
    out = {}
    for conv, turns in own.items():
        heads = zlib.crc32(str(conv).encode()) % 4
        lender = conv - int(math.fmod(conv, 20))
        out[conv] = own.get(lender, [])[:heads] + turns[heads:]
    return out


@pytest.mark.parametrize("size, seed", [(100_000, 1), (6, 2), (40, 3), (6, 4)])
def test_prefix_trie(spark, monkeypatch, size, seed):
    """Also with tasks of a few turns each, so that most nodes are known to several."""
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", size)
    rows = conversation_rows(seed)
    turns = prefix_trie.ordered_turns(written(spark.createDataFrame(rows, TURNS).repartition(3), "said"))
    conv = F.col("conv")
    lent = prefix_trie.with_borrowed_heads(turns, conv - conv % 20, F.crc32(conv.cast("string")) % 4, 3)
    for built, expected in ((lent, rebuilt(rows)), (turns, rebuilt(rows, False))):
        found = prefix_trie.prefix_nodes(built).select(COLUMNS).collect()
        assert sorted((tuple(r) for r in found), key=str) == plain_nodes(expected)


def test_prefix_trie_of_nothing_and_of_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", 3)
    empty = prefix_trie.ordered_turns(spark.createDataFrame([], TURNS))
    assert prefix_trie.prefix_nodes(empty).isEmpty()
    rows = [(c, t, "user", f"turn {t}", "x", 1, 2, 3) for c in range(300) for t in range(2 + (c == 299))]
    found = prefix_trie.prefix_nodes(prefix_trie.ordered_turns(spark.createDataFrame(rows, TURNS)))
    assert sorted((tuple(r) for r in found.select(COLUMNS).collect()), key=str) == plain_nodes(rebuilt(rows, False))


def test_ties_of_turns_are_ordered_alike_whatever_the_order_of_rows(spark):
    rows = [(1, 5, "user", text, "x", 1, 2, 3) for text in "abcdef"]
    some = prefix_trie.ordered_turns(spark.createDataFrame(rows, TURNS)).collect()
    others = prefix_trie.ordered_turns(spark.createDataFrame(rows[::-1], TURNS)).collect()
    assert sorted(map(tuple, some)) == sorted(map(tuple, others))


def test_z_fast_trie_finds_exit_nodes():
    draw = random.Random(9)
    trie, seen = prefix_trie.ZFastTrie(()), set()
    for _ in range(3000):
        symbols = tuple(draw.choice("ab") for _ in range(draw.randint(1, 30)))
        if symbols in seen:
            continue
        seen.add(symbols)
        path = [symbols[:d] for d in range(len(symbols) + 1)]  # a prefix is its own hash
        shared = max(len(p) for p in path if p == () or any(s[: len(p)] == p for s in seen - {symbols}))
        node = trie.exit_node(path)
        assert trie.low[node] < shared <= trie.high[node] or (node == 0 and shared == 0)
        trie.insert(path, [0] * len(path), (symbols, 1, ""))
    for node in range(1, len(trie.low)):
        assert trie.handles[trie._handle(node)] == node
        assert trie.low[node] == trie.high[trie.parent[node]]
        assert len(trie.children[node]) != 1 or trie.ending[node]
    assert len(trie.handles) == len(trie.low) - 1
    assert {trie.ending[n][0] for n in range(1, len(trie.low)) if trie.ending[n]} == seen


@pytest.mark.parametrize("low, high", [(0, 1), (3, 9), (8, 15), (0, 399), (6, 7)])
def test_two_fattest(low, high):
    def power(n):
        return n & -n

    assert prefix_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=power)


# --- shared search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(rows, items, count):
    docs = [(i, Counter(TERM.findall(lower(t or "")))) for i, t, *_ in rows]
    held = Counter(t for _, own in docs for t in own)
    n_docs, total = sum(1 for _, own in docs if own), sum(sum(own.values()) for _, own in docs)
    out = []
    for item_id, text in set(items):
        scores = []
        for i, own in docs:
            n, score = sum(own.values()), 0
            for term in TERM.findall(lower(text or "")):
                if own[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1)))
                    score += w * ((10**9 * own[term]) // (1000 * own[term] + 8 * (25 + 75 * n * n_docs // total)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item_id, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:count], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block, batch, count", [(200_000, 1024, 10), (10, 3, 4)])
def test_search(spark, monkeypatch, block, batch, count):
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    monkeypatch.setattr(search, "BATCH_DOCS", batch)
    rows = fixtures.awkward_documents()
    rows += [(None, rows[12][1], "en", None, None), (900, rows[12][1], None, None, None), rows[20], rows[20]]
    draw = random.Random(4)
    words = TERM.findall(" ".join(t for _, t, *_ in rows if t and len(t) < 3000))
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 25)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "zzzz unheard"), (33, items[3][1].upper() + " " + items[3][1]), items[5], (5, items[6][1])]
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("x"))
    found = search.search(fixtures.frame(spark, rows), asked, count)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_search(rows, items, count)


def test_search_of_nothing(spark):
    docs, asked = fixtures.frame(spark, fixtures.awkward_documents()), "item_id bigint, text string"
    assert search.search(docs, spark.createDataFrame([], asked)).isEmpty()
    assert search.search(docs, spark.createDataFrame([(1, "...")], asked)).isEmpty()
    assert search.search(fixtures.frame(spark, []), spark.createDataFrame([(1, "one")], asked)).isEmpty()


def test_shared_sets_are_scored_once():
    items = [[0, 1, 2, 3], [1, 0, 2, 4, 4], [2, 1, 0], [5, 5, 6], [7, 6, 5, 5], [], [8, 9]]
    graph = search.mine_shared_sets(items)
    values = np.arange(30).reshape(10, 3) ** 2
    expected = [values[item].sum(axis=0) if item else np.zeros(3, int) for item in items]
    assert search.shared_scores(graph, values).tolist() == [list(x) for x in expected]
    assert len(graph.members) < len({(t, i) for i, item in enumerate(items) for t in item})
    alike = search.mine_shared_sets([[3, 1, 2]] * 50)
    assert alike.nodes == 2 and len(alike.members) == 3


def test_few_kept_words_change_no_piece(spark):
    """The pipeline lets its workers keep fewer words than an operator on its own."""
    texts = [" ".join(f"word{(i * j) % 97} and" for j in range(60)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    file = queries.tokenizer_file(queries.BYTE_TOKENIZER)
    cut = [
        packing.cut_documents(docs, file, 0, 64, kept_words=kept).orderBy("doc_id", "piece").collect()
        for kept in (5, packing.KEPT_WORDS)
    ]
    assert cut[0] == cut[1]
    assert corpus_pipeline.KEPT_WORDS < packing.KEPT_WORDS
