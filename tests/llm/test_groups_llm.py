import random

from grainmill.llm import groups as G


def frames(spark, pairs, n_docs=60, per_file=7):
    files, docs = [], []
    at = {0: 0, 1: 0}
    rec = 1000
    for k in range(n_docs // per_file + 1):
        task = k % 2
        rows = min(per_file, n_docs - k * per_file)
        files.append((task, f"f{k}", "src", rows, at[task]))
        for j in range(rows):
            docs.append((rec - len(docs), f"f{k}", j, ("A ", "b", None, "")[len(docs) % 4]))
        at[task] += rows
    files += [files[0], (0, "gone", "src", 0, 500), (None, "x", "src", 3, 0)]
    f = spark.createDataFrame(files, "task_rank int, filepath string, source string, num_rows bigint, cumulative_start bigint")
    d = spark.createDataFrame([*docs, (None, "f0", 0, "b")], "rec_id bigint, filepath string, row_in_file bigint, source string").selectExpr("*", "1 as task", "2 as label", "3 as src")
    p = spark.createDataFrame(pairs, "task1 bigint, doc1 bigint, task2 bigint, doc2 bigint").selectExpr("*", "1 as bucket")
    where = {}
    for task, name, _, rows, start in files[: n_docs // per_file + 1]:
        for r, path, j, _ in docs:
            if path == name and j < rows:
                where[task, start + j] = r
    return p, f, d, where


def brute(pairs, where):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b, c, e in pairs:
        x, y = where.get((a, b)), where.get((c, e))
        if x is not None and y is not None and x != y:
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def check(spark, pairs, n_docs=60):
    p, f, d, where = frames(spark, pairs, n_docs)
    got = {r.rec_id: r.group_rec_id for r in G.groups_found(p, f, d).collect()}
    want = brute(pairs, where)
    assert got == want
    return p, f, d, want


def test_random_graph_with_dirty_pairs(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(2), draw.randrange(34), draw.randrange(2), draw.randrange(34)) for _ in range(35)]
    pairs += [pairs[0], pairs[1][2:] + pairs[1][:2], (0, 3, 0, 3), (0, None, 1, 2), (None, 1, 1, 2), (0, 9999, 1, 2), (0, -1, 1, 2), (7, 0, 1, 1)]
    p, f, d, want = check(spark, pairs)
    rows = G.group_sources(p, f, d).collect()
    assert sum(r.records for r in rows) == len(want)
    assert all(r.source == sorted(set(r.source)) and set(r.source) <= {"a", "b"} for r in rows)


def test_a_hub_and_a_long_chain(spark):
    hub = [(0, 0, 0, k) for k in range(1, 12)]
    chain = [(1, k, 1, k + 1) for k in range(25)]
    check(spark, hub + chain)


def test_nothing_links(spark):
    check(spark, [])
    check(spark, [(0, 1, 0, 1)])


def test_files_of_many_rows_are_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(G, "ROW_BLOCK", 3)
    check(spark, [(0, 1, 1, 5), (0, 6, 0, 20), (1, 5, 0, 6)])


def test_chains_that_hang_on_the_hub_end_in_few_jobs(spark, monkeypatch):
    """Layers are peeled up to a bound; a chain of any length behind them goes with the minimum propagation."""
    written = []
    keep = G.write_step
    monkeypatch.setattr(G, "write_step", lambda df, name="step", **m: written.append(name) or keep(df, name, **m))
    n = 3000
    edges = [(5, k) for k in range(10, 40)] + [(k, k + 1) for k in range(39, n)] + [(1, 12), (2, 3)]
    got = {r.v: r.label for r in G.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 5: 1} | dict.fromkeys(range(10, n + 1), 1)
    assert written.count("rest") == G.LAYERS


def test_hot_neighbours_are_joined_apart(spark, monkeypatch):
    from grainmill.operators import joins

    monkeypatch.setattr(G, "join_unique", lambda *a, **k: joins.join_unique(*a, **{**k, "n_rows": None, "hot_rows": 3}))
    edges = [(1, k) for k in range(2, 30)] + [(2, k) for k in range(40, 60)] + [(3, 70), (70, 71), (80, 81)]
    got = {r.v: r.label for r in G.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys([*range(1, 30), *range(40, 60), 70, 71], 1) | {80: 80, 81: 80}
