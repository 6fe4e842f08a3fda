"""The prefix trie against a plain version that lists the prefixes of every conversation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from clicktally.llm import trie
from clicktally.llm.queries import op12_skeleton_trie


def conversations(rows):
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            found[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in found.items()}


def rebuilt(found):
    out = {}
    for conv, turns in found.items():
        h = zlib.crc32(str(conv).encode()) % 9
        family = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        out[conv] = found.get(family, [])[:h] + turns[h:]
    return out


def plain_trie(found):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv in sorted(found):
        path = tuple(found[conv])
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
            if depth:
                children[path[: depth - 1]].add(path[:depth])
        ends[path].append(conv)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (
            convs[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(convs),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, convs in list(members.items())
    )


def test_op12(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    wanted = plain_trie(rebuilt(conversations(map(tuple, rows.collect()))))
    assert Counter(map(tuple, op12_skeleton_trie(spark, sf_dir).collect())) == wanted


def made_turns(seed, convs=300, alphabet=2, longest=9):
    """Conversations of few different turns, so that they share much; a third are equal."""
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        own = random.Random(1 if conv % 3 == 0 else rng.random())
        for turn in range(own.randint(1, longest)):
            text = own.choice(["ä", "bb", "", None][:alphabet])
            rows.append((conv * 7 - 40, turn, own.choice(["user", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
@pytest.mark.parametrize("seed", range(3))
def test_shards_give_the_whole_trie(spark, seed, shards):
    rows = made_turns(seed, alphabet=2 + seed)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for make, change in ((trie.conversation_paths, dict), (trie.rebuilt_paths, rebuilt)):
        paths = make(turns, shards).select("conv_id", "path")
        found = trie.prefix_trie(paths, shards).collect()
        assert Counter(map(tuple, found)) == plain_trie(change(conversations(rows)))


def test_copies_of_one_conversation_lie_in_many_shards(spark):
    rows = [(conv, turn, "user", f"text {turn}") for conv in range(600) for turn in range(3)]
    rows += [(conv, turn, "user", f"text {min(turn, conv % 5)}") for conv in range(600, 700) for turn in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    paths = trie.conversation_paths(turns, 8).select("conv_id", "path")
    dealt = paths.repartitionByRange(8, "path", "conv_id").rdd.glom().map(len).collect()
    assert max(dealt) < 200
    found = trie.prefix_trie(paths, 8).collect()
    assert Counter(map(tuple, found)) == plain_trie(conversations(rows))


def test_one_long_conversation_is_sorted_by_many_tasks(spark):
    rows = [(5, turn, "user", f"turn {turn} {'x' * (turn % 50)}") for turn in range(5000)]
    rows += [(conv, turn, "user", f"turn {turn} {'x' * (turn % 50)}") for conv in range(6, 60) for turn in range(9)]
    random.Random(2).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = trie.prefix_trie(trie.conversation_paths(turns, 8).select("conv_id", "path"), 8)
    measures = {(row.depth, row.conv_id): row for row in found.collect()}
    assert len(measures) == 5001
    assert measures[(9, 5)].n_convs == 55 and measures[(5000, 5)].n_children == 0
    assert measures[(0, 5)].n_leaves == 1


def test_odd_conversations(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, 0, "user", "a"),
        (None, 0, "user", "lost"), (2, None, "", ""), (7, 3, "user", "a" * 1_000_000), (8, 3, "user", None),
        (-3, 1, "user", "below"), (-5, 1, "user", "below"), (10, 0, "a", "b"), (11, 0, "", "ab"),
    ]
    turns = spark.createDataFrame(
        [(*row, "x", 1) for row in rows],
        "conv_id long, turn long, role string, text string, path string, shard int",
    )
    assert Counter(map(tuple, trie.conversation_trie(turns).collect())) == plain_trie(conversations(rows))
    found = trie.rebuilt_trie(turns)
    assert Counter(map(tuple, found.collect())) == plain_trie(rebuilt(conversations(rows)))
    assert found.columns == trie.NODE.names[:8]
    assert trie.rebuilt_trie(turns.limit(0)).collect() == []
