"""The training-data operators against brute force, on small tables that hold
nulls, empty and long texts, ties, repeated rows, extra columns, and nothing."""

import base64
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import decontaminate, embeddings, html, jaccard, langid, lines, mixing, perfect_hash, secrets, toxicity, warc
from tideline.llm.common import WordHasher, letter_words, white_space_words, words_of_many
from tideline.llm.components import components

DOCS = "doc_id long, text string, source string, size int, component_id string"


def docs_of(spark, rows):
    """(doc_id, text, source) with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], DOCS)


def lowest(ids, linked):
    low = {i: i for i in ids}
    for _ in ids:
        for a, b in linked:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_word_hashes_do_not_depend_on_the_split():
    h = WordHasher(white_space_words())
    text = "Aa bB\tçé\x0bend " * 200_000  # several pieces
    whole = h.words(text)
    assert len(whole) == 800_000 and len(set(whole.tolist())) == 4
    assert (words_of_many(h, ["aa BB", None, "", "çé"])[0] == whole[:2]).all()
    assert [len(x) for x in words_of_many(h, ["aa BB", None, "", "çé"])] == [2, 0, 0, 1]
    assert len(h.words("x" * 3_000_000 + " y")) == 2


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    levels, slot = perfect_hash.build(a, b)
    assert sorted(slot) == list(range(5000))
    probe = perfect_hash.Probe(*perfect_hash.pack(levels))
    assert (probe.slots(a, b) == slot).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (None, 3), (5, 5), (100, 90)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows):
    strip = " \t\n\x0b\f\r"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(strip))
    held = {}
    for n, (i, t, _) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, {})[("row", n) if i is None else i] = i if i is not None else -(2**63)
    out = []
    for i, t, _ in rows:
        own = (t or "").split("\n")
        me = i if i is not None else -(2**63)
        kept = [x for x in own if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and max(held[key(x)].values()) != me)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark):
    a, b = "The same line of more than forty characters, É", "another line that is long enough to count as well"
    rows = [(i, f"{a}\nown line {i}\n\t{b.upper() if i % 2 else b} ", "s") for i in range(6)]
    rows += [(7, a, None), (8, None, "s"), (9, "", "s"), (10, "short\n" * 5, "s"), (10, "short\n" * 5, "s"), (None, a, "s"), (12, f"{a}\n{a}", "s"), (13, "x" * 100_000, "s")]
    got = lines.dedup_lines(docs_of(spark, rows)).select("doc_id", "__tl_lines", "__tl_dropped", F.coalesce("text", F.lit(""))).collect()
    order = lambda r: str(r)
    assert sorted(map(tuple, got), key=order) == sorted(brute_lines(rows), key=order)
    assert lines.dedup_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_groups_stay_bounded_under_skew(spark, monkeypatch):
    say = lambda kind, i: f"{kind} line number {i} of more than forty characters"
    rows = [(None if i % 3 else 7, "\n".join([say("hot", 0), say("pair", i // 5), say("own", i)]), "s") for i in range(600)]
    rows += [(7, rows[0][1], "s")] * 300 + [(1000, say("pair", 3), "s")]
    drops = lines.dropped_lines(docs_of(spark, rows)).agg(F.max(F.size("drops")), F.count("*")).first()
    assert drops[0] <= 2 and drops[1] > 300  # a list for each text, of its own lines
    got = lines.dedup_lines(docs_of(spark, rows)).select("doc_id", "__tl_lines", "__tl_dropped", F.coalesce("text", F.lit(""))).collect()
    order = lambda r: str(r)
    assert sorted(map(tuple, got), key=order) == sorted(brute_lines(rows), key=order)
    monkeypatch.setattr(lines, "BLOCK_LINES", 50)
    held = [(i % 3, i % 7, n, 1, 5) for n, i in enumerate([0] * 1500 + list(range(500)))] + [(9, 9, n, n, n) for n in range(1500)]
    blocks = lines._blocks(spark.createDataFrame(held, "id long, row long, deal long, h1 long, h2 long"), 40).select("shard", F.size("h1s").alias("n")).collect()
    assert sum(r["n"] for r in blocks) == len(held) and max(r["n"] for r in blocks) <= 100
    assert sum(r["shard"] == 5 for r in blocks) > 20 and sum(r["shard"] == 6 for r in blocks) == 1


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)]
    rows, base = [], [[rng.choice(words) for _ in range(60)] for _ in range(6)]
    passage = [rng.choice(words) for _ in range(20)]
    for i in range(90):
        x = list(base[i % 6])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            x[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(x + (passage if i % 2 else [])), "s"))
    rows += [(200, None, "s"), (201, "", "s"), (202, " \t ", "s"), (203, "One Two", "s"), (204, "one two", "s"), (205, "one two three", "s"), (5, rows[5][1], "s"), (None, rows[7][1], "s"), (207, " ".join(words * 300), "s")]
    # sets held by null ids only: a bridge between two documents, and two near copies without any
    ends = [f"b{i}" for i in range(120)]
    rows += [(300, " ".join(ends), "s"), (None, " ".join(ends[4:] + ["x1", "x2", "x3", "x4"]), "s"), (301, " ".join(ends[8:] + [f"x{i}" for i in range(1, 9)]), "s")]
    alone = [f"c{i}" for i in range(80)]
    rows += [(None, " ".join(alone), "s"), (None, " ".join(alone[1:]), "s")]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t, _ in rows]
    # rows without id are nodes as well, and bridges; they name no class
    keys = [i if i is not None else 10**6 + n for n, (i, _) in enumerate(sets)]
    links = [(a, b) for (a, (_, x)), (b, (_, y)) in itertools.combinations(list(zip(keys, sets)), 2) if x and 100 * len(x & y) >= percent * len(x | y)]
    low = lowest(keys, links)
    got = jaccard.near_duplicates(docs_of(spark, rows), k, percent).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"]) for r in got))) == sorted(map(str, ((i, len(x)) for i, x in sets)))
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == {i: c for i, c in low.items() if i < 10**6}
    unnamed = [low[k] if low[k] < 10**6 else None for k in keys if k >= 10**6]
    assert sorted(map(str, unnamed)) == sorted(str(r["component_id"]) for r in got if r["doc_id"] is None)
    assert jaccard.near_duplicates(docs_of(spark, []), k, percent).count() == 0


def test_decontamination_finds_edited_items(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(12, 50)))) for i in range(30)] + [(99, None), (98, "too short")]
    rows, want = [], set()
    for i, t in items[:30]:
        x = t.split(" ")
        for _ in range(int(0.2 * len(x)) if i % 2 else 0):
            at = rng.randrange(len(x))
            x[at : at + 1] = rng.choice([[], [rng.choice(words)], [x[at], rng.choice(words)]])
        noise = [rng.choice(words) for _ in range(200)]
        cut = rng.randrange(200)
        rows.append((i, " ".join(noise[:cut]) + ' "' + ",\n".join(x).upper() + '" ' + " ".join(noise[cut:]), "s"))
        want.add((i, i))
    rows += [(1000 + j, " ".join(rng.choice(words) for _ in range(3000)), "s") for j in range(10)] + [(500, None, "s"), (501, "", "s"), (None, items[0][1], "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_of(spark, rows), bench).collect()}
    assert got - want == {(None, 0)} and len(want - got) <= 1
    kept = {r["doc_id"] for r in decontaminate.decontaminate(docs_of(spark, rows), bench).collect()}
    assert {500, 501, *range(1000, 1010)} <= kept and None not in kept
    empty = bench.limit(0)
    assert decontaminate.leaks(docs_of(spark, rows), empty).count() == 0
    assert decontaminate.decontaminate(docs_of(spark, []), bench).count() == 0


def test_decontamination_of_short_items_and_other_scripts(spark):
    rng = random.Random(5)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(45))
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(30))
    quoted = "\u201cThe river\u2014wide and slow\u201d it\u2019s said\u00a0to turn the old mill\u2026"
    items = [(1, f"\uff1f{han[:20]}\uff0c{han[20:]}\u3002"), (2, thai), (3, quoted), (4, "Paris"), (5, "blue whale"), (6, "one two three four"), (7, "\u5317\u4eac"), (8, "?!"), (9, "")]
    noise = " ".join(f"v{rng.randrange(500)}" for _ in range(40))
    edited = han[:10] + chr(0x9000) * 2 + han[13:]
    rows = [(1, f"{noise}\u300c{edited}\u300d{noise}"), (2, f"\u0e2f{noise} {thai[:9]} {thai[9:]}{noise}"), (3, f'{noise} "the river - wide and slow" it\'s said to turn the old mill... {noise}'), (4, "in PARIS, paris")]
    rows += [(5, "a blue\u00a0whale"), (6, "one two three, four"), (7, "\u6211\u5728\u5317\u4eac\u3002"), (20, "parisian blue the whale one two three \u5317\u6771\u4eac ?!"), (21, None), (22, han[:9])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.leaks(docs_of(spark, [(i, t, "s") for i, t in rows]), bench).collect()}
    assert {i: r["item_id"] for i, r in got.items()} == {i: i for i in range(1, 8)}
    assert [got[i]["edits"] for i in range(1, 8)] == [3, 0, 0, 0, 0, 0, 0] and got[1]["item_words"] == 45
    assert (got[4]["first_word"], got[4]["end_word"]) == (1, 2)


def test_decontamination_holds_one_block_of_items(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, [(i, f"some words {t} and more", "s") for i, t in items])
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 4)
    got = decontaminate.leaks(docs, bench)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()  # the scans, which hold the items, are done
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, i) for i in range(9)]


def test_best_run_is_the_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(60):
        p, t = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        row = np.zeros(len(t) + 1, int)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = np.array(new)
        assert decontaminate.best_run(p, t)[0] == row.min()


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None, "d"])) for i in range(4000)]
    rows += [(5000, None, "a"), (5001, "x " * 9000, "a"), (5002, "x", "é"), (None, "x y", "b"), (7, rows[7][1], rows[7][2])]
    docs = docs_of(spark, rows).withColumn("__tl_size", mixing.text_size(F.col("text")))
    got = mixing.plan(docs).withColumn("k", F.size("__tl_draws")).collect()
    assert len(got) == len(rows)
    size, weight = {}, {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    for r, s in enumerate(sorted(size, key=lambda x: (x is None, x or ""))):
        weight[s] = (5, 2, 1)[r % 3]
    target, total, open_ = {}, sum(size.values()), set(size)
    while True:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * size[s]
            open_.discard(s)
    target |= share
    taken = {}
    for r in got:
        assert r["k"] <= 3 and r["__tl_source_size"] == size[r["source"]]
        assert r["__tl_target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["k"] * r["__tl_size"]
    assert all(target[s] - 80 <= taken[s] <= target[s] + 1e-6 for s in size)
    again = {(r["doc_id"], r["k"]) for r in mixing.plan(docs.repartition(7)).withColumn("k", F.size("__tl_draws")).collect()}
    assert again == {(r["doc_id"], r["k"]) for r in got}
    mixed = mixing.mix(docs.drop("__tl_size"))
    assert mixed.count() == sum(r["k"] for r in got)
    assert mixing.mix(docs_of(spark, [])).count() == 0


def test_mixing_takes_some_of_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 100)
    for same in (True, False):  # one text, or many of one size, under a null or a repeated id
        rows = [(None if i % 2 else 5, " ".join(["w"] * 9 + ["w" if same else f"v{i}"]), "a") for i in range(3000)] + [(10 + i, "x " * 45, "b") for i in range(500)]
        got = mixing.plan(docs_of(spark, rows).withColumn("__tl_size", mixing.text_size(F.col("text")))).withColumn("k", F.size("__tl_draws")).collect()
        assert len(got) == 3500 and max(r["k"] for r in got) <= 3
        for source in ("a", "b"):
            own = [r for r in got if r["source"] == source]
            assert abs(sum(r["k"] * r["__tl_size"] for r in own) - own[0]["__tl_target"]) < 0.02 * own[0]["__tl_target"]


def test_shard_quotas_are_exact():
    counts = np.array([100, 3, 57, 0, 41])
    rows = np.stack([mixing.shard_quotas(counts, s, 7, 1) for s in range(7)])
    assert (rows.sum(axis=0) == counts).all() and rows.sum(axis=1).max() - rows.sum(axis=1).min() <= 1 and (rows >= 0).all()


def test_secrets(spark):
    access, key = "AKIA" + "Q7" * 8, "aB3" * 10
    hexa = "0123456789abcdef" * 2
    rows = [
        (1, f"id {access} then {key} and https://host.example/x", "s"),
        (2, f"only {key} here", "s"),
        (3, f"é TOKEN = 'abc' Password: \"{hexa}\" user=jane https://db.example:1", "s"),
        (4, f"{key}\n\n{access}", "s"),
        (5, f"{access} {'x ' * 400} {key}", "s"),
        (6, None, "s"), (7, "", "s"), (1, f"id {access} then {key} and https://host.example/x", "s"), (None, f"a_b AKIA{'Z' * 3} secret = token : abcdefgh", "s"),
        (9, f"api_key={hexa} " * 3000, "s"),
    ]
    got = secrets.scan(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(rows, key=lambda r: str(r[0]))):
        t = t or ""
        base = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(base))
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))
    linked = {r["doc_id"]: r["n_linked"] for r in got}
    assert linked[1] == 2 and linked[2] == linked[4] == linked[5] == linked[6] == linked[7] == 0 and linked[3] == 2
    assert secrets.scan(docs_of(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, size int, digest string"


def test_warc_round_trip(spark):
    same = "<p>é same</p>"
    rows = [(i, f"http://x.example/{i} a\n", same if i % 3 == 0 else f"<p>{i}</p>\r\n\r\n") for i in range(60)]
    rows += [(70, None, None), (71, "u", ""), (None, "u", same), (5, "u", rows[5][2]), (80, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], PAGES).repartition(5)
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    payload = lambda h: (h or "").encode()
    top = {}
    for i, _, h in rows:
        top[payload(h)] = max(top.get(payload(h), -1), -1 if i is None else i)
    by = {(i, len(payload(h))): payload(h) for i, _, h in rows}
    for r in got:
        p = by[(r["page_id"], r["payload_bytes"])]
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
        assert (r["refers_to"] == top[p]) if r["record_type"] == "revisit" else r["page_id"] == top[p]
    assert sum(r["record_type"] == "response" for r in got) == len(top)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_arc_versions():
    for number, fields in warc.FIELDS.items():
        line = warc.arc_line(number, "http://a", "1.2.3.4", warc.FIRST_DATE, "text/html", "200", 3)
        said, body = warc.parse_arc(line + b"abc\n", fields)
        assert (said["URL"], said["Archive-date"], body) == ("http://a", "20000101000000", b"abc")
        with pytest.raises(ValueError):
            warc.parse_arc(line + b"ab", fields)


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(400):
        v = base[i % 40] + rng.normal(size=16) * rng.choice([0, 0.03, 0.08, 0.5])
        rows.append((i, [float(x) for x in v * rng.choice([1, 2])], int(i % 3)))
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [1.0, None], 1), (503, [float("nan")] * 16, 1), (504, rows[0][1], None), (505, rows[3][1], 0), (3, rows[3][1], 0), (506, [], 1), (507, [1.0], 1), (None, rows[9][1], 0)]
    got = embeddings.link_vectors(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n long")).collect()
    ok = [r for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    n = [0] * len(ok)
    links = []
    for (a, x), (b, y) in itertools.combinations(list(enumerate(ok)), 2):
        if x[2] == y[2] and len(x[1]) == len(y[1]) and np.dot(x[1], y[1]) / np.linalg.norm(x[1]) / np.linalg.norm(y[1]) >= 0.98:
            n[a] += 1
            n[b] += 1
            if None not in (x[0], y[0]):
                links.append((x[0], y[0]))
    low = lowest([r[0] for r in rows if r[0] is not None], links)
    assert len(got) == len(rows)
    assert sorted((str(r["vec_id"]), r["n_links"]) for r in got if r["n_links"]) == sorted((str(r[0]), k) for r, k in zip(ok, n) if k)
    assert {r["vec_id"]: r["component_id"] for r in got if r["vec_id"] is not None} == low
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_cells_lose_no_pair():
    rng = np.random.default_rng(8)
    x = embeddings.unit(rng.normal(size=(600, 8)))
    y = embeddings.unit(x + rng.normal(size=x.shape) * 0.04)
    c = embeddings.spherical_kmeans(x, 12)
    far = np.sqrt(2 - 2 * 0.98)
    apart = np.linalg.norm(c[:, None] - c[None], axis=2)
    home = (x @ c.T).argmax(axis=1)
    near = y @ c.T
    own = near.argmax(axis=1)
    visits = near[np.arange(600), own][:, None] - near <= far * apart[own] + 1e-9
    close = (x * y).sum(axis=1) >= 0.98
    assert close.sum() > 100 and visits[np.arange(600), home][close].all()


def test_toxicity_learns_from_labels_and_scores_text_alone(spark):
    rng = random.Random(9)
    clean = [f"c{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rows = []
    for i in range(900):
        bad = i % 6 == 0
        rows.append((i, " ".join(rng.choice(clean) for _ in range(40)) + (f" vilest{rng.choice('abcdef')}" * 2 if bad else ""), "s"))
    labels = spark.createDataFrame([(i, int(i % 6 == 0), "z") for i in range(600)] + [(None, 1, "z"), (601, None, "z"), (0, 1, "z")], "doc_id long, toxic int, text string")
    docs = docs_of(spark, rows + [(2000, None, "s"), (2001, "", "s"), (None, "VILESTA vilestb", "s"), (2002, "word " * 100_000, "s")])
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["__tl_score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 6 == 0) for i in range(900))
    assert got[None] >= 0.5 and got[2000] == got[2001] < 0.5 and all(0 <= s <= 1 for s in got.values())
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, none).filter("__tl_score >= 0.5").count() == 0


def test_language_by_compression(spark):
    rng = random.Random(10)
    own = {"aa": ["the", "and", "other", "with", "that"], "bb": ["der", "und", "nicht", "mit", "eine"], "cc": ["les", "pour", "avec", "une", "dans"]}
    make = lambda lang, n: " ".join(rng.choice(own[lang]) for _ in range(n))
    rows = [(i, make(lang := "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2], rng.randint(5, 80)), lang) for i in range(300)]
    rows += [(400, None, "aa"), (401, "", None), (402, "12 !! 34", "bb"), (None, make("bb", 9).upper(), None), (403, make("cc", 20_000), None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    data = langid.dictionaries(docs)
    got = {r["doc_id"]: r for r in langid.classify(docs, data).collect()}
    assert all(got[i]["__tl_lang"] == rows[i][2] for i in range(300))
    assert [got[i]["__tl_lang"] for i in (400, 401, 402, None, 403)] == ["und", "und", "und", "bb", "cc"]
    assert all(0 <= r["__tl_score"] <= 1 for r in got.values())
    assert langid.classify(docs, []).filter("__tl_lang <> 'und'").count() == 0


def test_main_text():
    words = "river stone and the tall green window over many small houses near water".split()
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    pages = []
    for _ in range(60):
        body = "".join(f"<p>{say(rng.randint(6, 30))}</p>" for _ in range(rng.randint(2, 6)))
        pages.append(f"<html><body><nav><ul><li><a href=/>{say(1)}</a></li></ul></nav><div class=ad>{say(6)}</div><article><h1>{say(5)[:-1]}</h1>{body}</article><footer>&copy; {say(6)}</footer></body></html>")
    tagger = html.train_on(html.labelled(pages))
    page = f"<html><body><header>{say(4)}</header><aside class='sidebar'><p>{say(9)}</p></aside><main><h1>Head &amp; tail</h1><p>{(one := say(20))}<script>x='<p>no</p>'</script></p><p>A  b\n&eacute; {(two := say(15))}</p></main><section id=comments><p>{say(12)}</p></section><form>{say(5)}</form><footer>{say(8)}</footer></body>"
    assert tagger.main_text(page) == f"Head & tail\n{one}\nA b é {two}"
    assert tagger.main_text(None) == tagger.main_text("") == tagger.main_text("<p>") == ""
    assert len(html.blocks("<div>" * 5000 + "x")) == 1


def test_main_text_leaves_out_parts_inside_the_article():
    say = lambda x, n: " ".join([x] * n) + "."
    page = (
        f"<body class='comments-open'><form><main class=has-sidebar><article><header><h1>Title here</h1></header><p>{say('one', 20)}</p>"
        f"<nav><a href=/>menu</a></nav><div class='advert'>{say('buy', 9)}</div><p>{say('two', 20)}</p><div id=cookie-notice><p>{say('cookies', 9)}</p></div>"
        f"<form><p>{say('mail', 5)}</p></form><section id=comments><article class=comment><p>{say('reply', 20)}</p></article></section></article>"
        f"<aside><article><p>{say('teaser', 12)}</p></article></aside></main></form></body>"
    )
    want = ["Title here", say("one", 20), say("two", 20)]
    assert [b.text for b in html.blocks(page) if b.inside] == want
    assert [label for _, label in zip(*html.labelled([page])[0])] == [int(b.text in want) for b in html.blocks(page)]
    assert html.train_on(html.labelled([page] * 20)).main_text(page).split("\n") == want


@pytest.mark.parametrize("layout", ["<div class=post-content>{}</div>", "<article>{}</article>", "<div>{}</div>"])
def test_main_text_of_pages_of_any_layout_and_length(spark, layout):
    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice("river stone and the tall green window".split()) for _ in range(n)) + "."
    rows, want = [], {}
    for i in range(8):
        body = [say(30) for _ in range(200 if layout.startswith("<article") else 12)]  # over 20,000 characters
        rows.append((i, "u", "<body><nav><a href=/>Home</a></nav>" + layout.format("".join(f"<p>{x}</p>" for x in body)) + f"<footer>&copy; {say(4)}</footer></body>"))
        want[i] = "\n".join(body)
    rows += [(8, "u", None), (9, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["__tl_text"] for r in html.extract(pages, html.train(pages)).collect()}
    assert got == want | {8: "", 9: ""}
    with pytest.raises(ValueError):
        html.train_on([])


def test_viterbi_and_marginals_agree_with_all_paths():
    rng = np.random.default_rng(12)
    scores, step = rng.normal(size=(5, 2)), rng.normal(size=(2, 2))
    paths = list(itertools.product((0, 1), repeat=5))
    value = [sum(scores[i, p[i]] for i in range(5)) + sum(step[p[i], p[i + 1]] for i in range(4)) for p in paths]
    assert html.viterbi(scores, step) == list(paths[int(np.argmax(value))])
    chance = np.exp(value) / np.exp(value).sum()
    one = sum(c for c, p in zip(chance, paths) if p[2] == 1)
    assert html.marginals(scores, step)[0][2, 1] == pytest.approx(one)
