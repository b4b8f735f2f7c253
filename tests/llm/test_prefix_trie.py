import hashlib
import random
import zlib

import numpy as np
import pytest

from leadpulse.llm import prefix_trie, registry

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.01"


def brute(rows):
    """Sorted node rows, from the definition."""
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append(
                ((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    convs = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        seq = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], ([], []))[0].append(c)
        nodes[seq][1].append(c)
    kids, leaves, saved = {}, {}, {}
    for prefix in nodes:
        if prefix:
            kids[prefix[:-1]] = kids.get(prefix[:-1], 0) + 1
    for prefix, (members, _) in nodes.items():
        own = (len(members) - 1) * len(prefix[-1][1].decode()) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] = leaves.get(prefix[:d], 0) + (prefix not in kids)
            saved[prefix[:d]] = saved.get(prefix[:d], 0) + own
    out = []
    for prefix, (members, ends) in nodes.items():
        text = ",".join(map(str, sorted(ends)))
        up = min(nodes[prefix[:-1]][0]) if prefix else None
        out.append((min(members), len(prefix), up, len(members), kids.get(prefix, 0),
                    leaves[prefix], saved[prefix], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_sql_and_brute_force(spark, duck):
    got = registry.QUERIES["op13_prefix_trie"](spark, SF)
    duck.execute(f"create or replace temp view conversations as"
                 f" select * from read_parquet('{SF}/conversations.parquet')")
    sql = duck.execute(registry.ORACLE_SQL["op13_prefix_trie"])
    assert got.columns == [d[0] for d in sql.description]
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()
    assert result(got) == sorted(sql.fetchall(), key=repr) == brute(rows)


def some_turns(n, seed=0):
    """Conversations of few different turns, some long, with nulls, ties and repeats."""
    rng = random.Random(seed)
    rows = []
    for c in range(-20, n):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 60 if rng.random() < 0.05 else 4])):
            rows.append((c, rng.choice([None, turn, turn]), rng.choice(["user", None, ""]),
                         rng.choice(["a", "bb", "é\U0001f600", None])))
    rows += [(None, 1, "user", "x"), (500, None, None, None), (700, 0, "user", "a")]
    return rows + rows[:10]


@pytest.mark.parametrize("shard_rows, piece, ends", [(4, 3, 2), (4096, 1024, 4096)])
def test_levels_shards_and_pieces(spark, monkeypatch, shard_rows, piece, ends):
    rows = some_turns(260)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    df = spark.createDataFrame(rows, SCHEMA)
    turns, convs = prefix_trie.ordered_turns(spark, df)
    rebuilt = prefix_trie.shared_openings(spark, turns, convs)
    assert result(prefix_trie.trie(spark, *rebuilt, shard_rows=shard_rows)) == brute(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.opening_trie(spark, empty).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert prefix_trie.opening_trie(spark, nobody).collect() == []
    # Id 1 shares two turns of conversation 0, which is not there, and has one itself.
    assert zlib.crc32(b"1") % 6 == 5
    rows = [(1, 0, "user", "x" * 100000)]
    wide = spark.createDataFrame([(*r, 1, "n") for r in rows],
                                 SCHEMA + ", depth long, high string")
    got = result(prefix_trie.opening_trie(spark, wide))
    assert got == brute(rows) and got[0][:4] == (1, 0, None, 1)


def test_copies_of_one_conversation_meet_in_few_rows(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 30000, 100) for t in range(3)]
    assert result(prefix_trie.opening_trie(spark, spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20000):
        high, low = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        high[n // 2:] = 7  # names may share a half
        low[:n // 3] = 9
        table = prefix_trie.NodeTable(high, low)
        assert sorted(table.slot.tolist()) == list(range(n))
        assert (table.find(high, low) == table.slot).all()
        assert (table.find(high ^ np.uint64(1 << 63), low) == -1).all()


def test_a_name_of_two_prefixes_is_an_error(spark):
    rows = [(1, 0, 0, 0, 0, 0, 5, 1, 1), (2, 0, 0, 0, 0, 0, 6, 1, 1)]
    cols = "conv_id, depth, high, low, up_high, up_low, check, chars, below".split(", ")
    entries = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in cols))
    with pytest.raises(Exception, match="share a name"):
        prefix_trie._nodes(spark, entries).collect()
