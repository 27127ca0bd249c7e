import collections
import random

import pytest

from lexiflow.llm import jaccard_join as J


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k
                    else frozenset([tuple(w)]) if w else frozenset())
    par = list(range(len(rows)))

    def root(a):
        while par[a] != a:
            a = par[a]
        return a

    for i, s in enumerate(sets):
        for j in range(i):
            n = len(s & sets[j])
            if s and sets[j] and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                par[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return collections.Counter(
        (d, len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), [root(i) for i in range(len(rows))], sets


def near_copies(seed, n=260, vocabulary=50):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 100))] for _ in range(12)]
    base.append(base[0][:40] + base[1][:40])  # shares passages with two others
    rows = []
    for i in range(n):
        b = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        if rnd.random() < 0.2:
            b = b[:max(1, len(b) - rnd.randint(0, 10))]
        rows.append((rnd.choice([i, i, i, 7, None]), " ".join(b)))
    return rows + [(1000, ""), (1001, None), (1002, " \t "), (None, None), (3, "A b"), (4, "a B"), (5, "a b c"), (5, "a b c")]


@pytest.mark.parametrize("cfg", [
    J.JoinConfig(), J.JoinConfig(rounds=1, chunk_shingles=1500), J.JoinConfig(shingle=2, percent=60, rounds=1, chunk_shingles=400),
    J.JoinConfig(shingle=5, percent=80, range_shingles=500)])
def test_equals_brute_force(spark, stored, cfg):
    rows = near_copies(cfg.percent + cfg.rounds)
    df = stored(rows, "doc_id long, text string").selectExpr("*", "1 as rid", "2 as x", "'c' as sig")
    got = collections.Counter(tuple(r) for r in J.join_documents(df, cfg=cfg).collect())
    assert got == brute(rows, cfg.shingle, cfg.percent)[0]


def test_one_row_of_each_group_stays(spark, stored):
    cfg = J.JoinConfig(shingle=5, percent=80)
    rows = near_copies(9)
    df = stored(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in J.first_of_each(df, cfg=cfg).collect()]
    _, roots, sets = brute(rows, 5, 80)
    groups = collections.defaultdict(list)
    for i, r in enumerate(roots):
        groups[r if sets[i] else ("empty", i)].append(rows[i])
    assert len(kept) == len(groups)
    for members in groups.values():
        ids = [d for d, _ in members if d is not None]
        assert any(m in kept and m[0] == (min(ids) if ids else None) for m in members)


def test_hot_groups_do_not_pair_up(spark, stored):
    """500 near copies of one text: pairs verified stay linear in the group."""
    rnd = random.Random(1)
    base = [f"v{rnd.randrange(10**6)}" for _ in range(80)]
    rows = [(i, " ".join(base[:j] + [f"own{i}"] + base[j + 1:])) for i in range(400) for j in [rnd.randrange(80)]]
    rows += [(1000 + i, " ".join(base)) for i in range(300)]
    df = stored(rows, "doc_id long, text string")
    got = J.join_documents(df, cfg=J.JoinConfig(percent=80)).collect()
    assert {r.component_id for r in got} == {0}
    src = J.row_ids(df.selectExpr("doc_id as id", "text"), "rid").select("rid", "id", "text")
    sets = J.sets_of(src.select("rid", "text").dropDuplicates(["text"]), 4).cache()
    posts = J.prefixes(sets, J.JoinConfig(percent=80)).selectExpr("0L as g", "h", "x", "n", "own", "cast(null as long) as cls")
    links, left = J.pivot_round(posts, sets, J.JoinConfig(percent=80))
    assert links.count() < 5 * 401 and left.count() == 0


def test_single_and_empty(spark, stored):
    assert [tuple(r) for r in J.join_documents(stored([(1, "a")], "doc_id long, text string", 1)).collect()] == [(1, 1, 1)]
    assert J.join_documents(stored([], "doc_id long, text string", 1)).count() == 0
