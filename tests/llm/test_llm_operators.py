"""The operators against brute force, and on nulls, empty tables, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import katz, leaks, lines, mixing, ordinal, pii, quality, repeats, simhash, urls
from tidemark.llm.components import components
from tidemark.llm.simhash import _forest, fingerprint_links

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
A_LONG = " ".join(f"w{i % 997} the" for i in range(30_000)) + "."


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def odd_rows():
    """Null ids, texts and sources, empty and long texts, repeated rows and ids."""
    prose = "The quick brown fox jumps over the lazy dog again. " * 3 + "Nothing else is said of it."
    return [
        (1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, prose + " More.", "en", None, 1), (3, None, None, None, None),
        (4, "", "en", "b", 0), (None, prose, "en", "b", 1), (None, None, None, "b", None), (5, A_LONG, "en", "a", 5), (6, " \n\t\n ", "en", "c", 5),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs):
    extra = ["size", "target", "kept", "cleaned", "pos", "line", "owner", "vertex", "n", "batch", "first", "mask", "fp", "copies", "n_lines", "rule", "_x"]
    return docs.selectExpr("*", *[f"'x' AS {c}" for c in extra])


RUNS = {
    "katz": lambda d: katz.katz_scores(d),
    "simhash": lambda d: simhash.near_digest(d),
    "quality": lambda d: quality.quality_report(d),
    "mix": lambda d: mixing.mix(d).select("doc_id", "size", "source_size", "target", "taken"),
    "lines": lambda d: lines.line_digest(d),
    "repeats": lambda d: repeats.repeat_digest(d),
    "pii": lambda d: pii.personal_digest(d),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows_empty_tables_and_clashing_columns(odd, none, name):
    run = RUNS[name]
    rows = sorted(map(repr, run(odd).collect()))
    assert len(rows) == len(odd_rows())
    assert sorted(map(repr, run(clashing(odd)).collect())) == rows
    assert run(none).collect() == []


def test_stages_keep_columns(spark, odd, none):
    stages = {
        "quality": quality.keep_good,
        "lines": lambda d: lines.dedup_lines(d).drop("n_dropped"),
        "near": lambda d: simhash.drop_near_duplicates(d),
    }
    for name, stage in stages.items():
        for docs in (odd, none, clashing(odd)):
            done = stage(docs)
            assert set(docs.columns) <= set(done.columns), name
            assert done.count() <= docs.count()
    assert simhash.drop_near_duplicates(odd).where("doc_id = 1").count() == 1


def test_katz_sums_to_one_and_beats_the_base(spark):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(["Aa", "b", "c", "d", "e"], rng.integers(0, 30), p=[0.4, 0.3, 0.15, 0.1, 0.05])) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in katz.katz_scores(docs, block_tokens=500).collect()}
    tokens = {i: [*words(lowered(t)), "\n"] for i, t in texts.items()}
    train = [t for i, t in tokens.items() if not rows[i]["held_out"]]
    count = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([None, *t], t))
    heads = collections.Counter(h for t in train for h in [None, *t[:-1]])
    total = sum(count.values())
    of = lambda c: [sum(v == r for v in c.values()) for r in range(1, 7)]
    d1, d2 = katz.discounts(of(count)), katz.discounts(of(pairs))
    cut = lambda c, d: c * (d[c] if c <= 5 else 1)
    mass = sum(cut(c, d1) for c in count.values())
    everything = total if mass < total - 1e-9 else total + 1
    p1 = lambda w: cut(count[w], d1) / everything if w in count else 1 - mass / everything

    def p2(h, w):
        if not heads[h]:
            return p1(w)
        kept = {x: cut(c, d2) for (g, x), c in pairs.items() if g == h}
        size = heads[h] if sum(kept.values()) < heads[h] - 1e-9 else heads[h] + 1
        if w in kept:
            return kept[w] / size
        return (1 - sum(kept.values()) / size) / (1 - sum(p1(x) for x in kept)) * p1(w)

    for h in [None, *list(count)[:4]]:
        assert sum(p2(h, w) for w in [*count, "\t"]) == pytest.approx(1)
    for i, t in tokens.items():
        assert rows[i]["score"] == pytest.approx(sum(math.log10(p2(h, w)) for h, w in zip([None, *t], t)))
        assert rows[i]["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in t))
        assert (rows[i]["n_tokens"], rows[i]["train_tokens"]) == (len(t), total)


def brute_fingerprint(text):
    found = words(lowered(text))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark, odd):
    rows = simhash.near_digest(odd).collect()
    want = collections.Counter((r[0], f"{brute_fingerprint(r[1]):016x}") for r in odd_rows())
    assert collections.Counter((r["doc_id"], r["fingerprint"]) for r in rows) == want
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {3}


def test_near_duplicates_by_similarity(spark):
    rng = np.random.default_rng(17)
    vocabulary = np.array([f"v{i}" for i in range(3000)])
    rows, similarity = [], {}
    for d in range(300):
        text = rng.choice(vocabulary, 200)
        copy = text.copy()
        copy[rng.choice(200, [2, 3, 14][d % 3], replace=False)] = "other"
        rows += [(2 * d, " ".join(text)), (2 * d + 1, " ".join(copy))]
        a, b = ({tuple(t[i : i + 5]) for i in range(196)} for t in (text, copy))
        similarity[d] = len(a & b) / len(a | b)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(2 * d in kept for d in similarity)
    found = lambda low, high: np.mean([2 * d + 1 not in kept for d, j in similarity.items() if low <= j < high])
    assert found(0.89, 1) >= 0.93 and found(0.84, 0.89) >= 0.7 and found(0, 0.7) <= 0.02


@pytest.mark.parametrize("max_bits", [2, 4])
def test_index_finds_every_link_of_hot_nodes(spark, tmp_path, max_bits):
    rng = np.random.default_rng(max_bits)
    centre = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(1500)], np.uint64)
    values = np.unique(np.r_[centre ^ flips, rng.integers(0, 1 << 63, 500, dtype=np.uint64)])
    signed = values.view(np.int64).tolist()
    fps = spark.createDataFrame([(v, [v], v.to_bytes(8, "little", signed=True)) for v in signed], "vertex bigint, fps array<bigint>, code binary")
    stars = components(fingerprint_links(fps, max_bits, str(tmp_path), leaf=128), str(tmp_path))
    root = dict(stars.collect())
    pairs = [np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ v) <= max_bits) + i + 1 for i, v in enumerate(values)]
    label = _forest(len(values), np.repeat(np.arange(len(values)), [len(p) for p in pairs]), np.concatenate(pairs))
    got = collections.defaultdict(set)
    for v in signed:
        got[root.get(v, v)].add(v)
    want = collections.defaultdict(set)
    for v, k in zip(signed, label):
        want[k].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_leaks_reach_recall_on_edited_items(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"t{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(14, 60)))) for i in range(60)]
    docs, planted = [], set()
    for d in range(240):
        text = list(rng.choice(vocabulary, 120))
        if d % 2:
            i, item = items[d % 60]
            item = item.split()
            for _ in range(int(0.1 * len(item))):
                at = rng.integers(0, len(item))
                kind = rng.integers(0, 3)
                item[at : at + (kind != 0)] = [] if kind == 1 else [str(rng.choice(vocabulary))]
            at = rng.integers(0, 120)
            text[at:at] = item
            planted.add((d, i))
        docs.append((d, " ".join(text)))
    found = leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(got & planted) >= 0.95 * len(planted)
    assert not got - planted


def test_leaks_on_odd_tables(spark, odd, none):
    items = spark.createDataFrame([(1, "nothing else is said of it."), (None, "a b c d e f g"), (2, None), (3, "too short")], "item_id bigint, text string")
    rows = leaks.find_leaks(odd, items).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in rows} == {(1, 1, 0), (2, 1, 0), (None, 1, 0)}
    assert leaks.find_leaks(none, items).count() == 0 == leaks.find_leaks(odd, items.limit(0)).count()
    assert leaks.drop_leaked(clashing(odd), items).where("doc_id < 3 OR text LIKE 'The%'").count() == 0


def test_infix_edits_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 9)).tolist(), rng.integers(0, 4, rng.integers(0, 14)).tolist()
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item):
            new = [i + 1]
            for j, y in enumerate(text):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert leaks.infix_edits(item, text)[0] == min(row)


def test_personal_data_patterns_and_field(spark):
    texts = [
        "write to a.b+c@mail.example.com, or x@y now", "at 10.0.0.256 and 1.2.3.4.5.6.7.8", "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
        "call +1 (456) 555-2186 or (456) 555-2186.", "é ü +44 20 7946 0958", "in 1999 there were 12,345 of 3.14", None, "", "a@b@c.de@f.gh " * 50 + "1" * 5000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in pii.personal_digest(docs).collect()}
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    bare = lambda s: re.sub("[^0-9]", "", s)
    for i, text in enumerate(texts):
        text = text or ""
        base = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        if len(text) < 5000:
            base += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        base += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(bare(m[0])) <= 19 and luhn(bare(m[0]))]
        base += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(bare(m[0])) <= 15]
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (s[1], pii.KINDS.index(s[0]))))
        assert rows[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest(), text
        assert set(filter(None, written.split(","))) <= set(rows[i]["spans"].split(","))
    assert rows[3]["n_added"] == 1 and rows[5]["n_added"] == 0


def test_field_on_held_out_sentences():
    field = pii.fit(pii.labelled_examples(900, seed=1), rounds=80)
    hits = total = 0
    for text, spans in pii.labelled_examples(300, seed=2):
        runs = pii.segments(text)
        got = {k for k, _, _ in pii.added_spans(text, runs, field.decode(runs), [])}
        total += 1
        hits += got == {s[0] for s in spans}
    assert hits / total > 0.9


def test_ordinal_model_grades_held_out_texts(spark):
    rng = np.random.default_rng(9)
    rows, ratings = [], []
    for i in range(600):
        text = list(rng.choice([f"n{j}" for j in range(50)], 60))
        grade = i % 3
        if grade == 0:
            text = [w.upper() + "!!" for w in text]
        if grade == 1:
            text[rng.integers(0, 60)] = "vile"
        rows.append((i, " ".join(text)))
        if i < 400:
            ratings.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = ordinal.train(docs, spark.createDataFrame(ratings, "doc_id bigint, grade int"), 3)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in ordinal.classify(docs, model).collect()}
    assert np.mean([got[i]["kept"] == (i % 3 == 2) for i in range(400, 600)]) > 0.97
    for r in got.values():
        assert r["expected_grade"] == pytest.approx(r["p_above_lowest"] + r["p_highest"])


def test_ordinal_on_odd_tables(spark, odd, none):
    ratings = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (None, 2), (3, None), (5, 7)], "doc_id bigint, grade int")
    model = ordinal.train(odd, ratings, 3)
    assert ordinal.classify(clashing(odd), model).count() == len(odd_rows())
    blank = ordinal.train(none, ratings.limit(0), 3)
    assert ordinal.classify(none, blank).count() == 0 and ordinal.classify(odd, blank).count() == len(odd_rows())


def test_mix_comes_near_its_targets_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 40)), None if s == 4 else f"s{s}") for i, s in enumerate(rng.choice(5, 3000, p=[0.6, 0.2, 0.1, 0.09, 0.01]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first, again = (sorted(map(repr, mixing.mix_digest(docs).collect())) for _ in range(2))
    assert first == again
    taken, target, size = collections.Counter(), {}, {}
    for r in mixing.mix_digest(docs).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert r["taken"] <= 3 * r["size"]
    total, weight = sum(size.values()), dict(zip(["s0", "s1", "s2", "s3", None], [5, 2, 1, 5, 2]))
    want, capped = {}, set()
    while True:
        rest = total - sum(3 * size[s] for s in capped)
        open_ = sum(weight[s] for s in size if s not in capped)
        want = {s: 3.0 * size[s] if s in capped else rest * weight[s] / open_ for s in size}
        above = {s for s in size if want[s] > 3 * size[s]}
        if not above:
            break
        capped |= above
    assert target == pytest.approx(want)
    for s in size:
        assert abs(taken[s] - target[s]) <= 40


def test_line_runs_keep_first_owners_over_many_batches(spark, odd):
    many = spark.createDataFrame([(i, f"A common line here\nline number {i // 2} of all\nshort") for i in range(40)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in lines.dedup_lines(many, batches=7, fan_in=2).collect()}
    for i in range(40):
        assert rows[i]["n_dropped"] == (i > 0) + i % 2
        assert rows[i]["text"].endswith("short")
    by_id = collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in lines.line_digest(odd).collect())
    assert by_id[(1, 1, 0)] == 2 and by_id[(None, 1, 1)] == 1 and by_id[(6, 3, 0)] == 1


def test_repeats_at_the_edges_of_passages(spark):
    rng = np.random.default_rng(8)
    shared = [f"s{i}" for i in range(120)]
    rows = []
    for d in range(30):
        a, b = sorted(rng.integers(0, 120, 2).tolist())
        rows.append((d, " ".join([f"d{d}x{i}" for i in range(20)] + shared[a:b] + [f"d{d}y{i}" for i in range(20)])))
    rows += [(100, "the " * 200), (101, "the " * 200), (102, rows[3][1])]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    first, texts = {}, {d: words(t) for d, t in rows}
    for d, t in sorted(texts.items()):
        for i in range(len(t) - 49):
            first.setdefault(tuple(t[i : i + 50]), d)
    for d, t in texts.items():
        gone = {p for i in range(len(t) - 49) if first[tuple(t[i : i + 50])] < d for p in range(i, i + 50)}
        assert got[d]["n_removed"] == len(gone)
        assert got[d]["kept_text"] == " ".join(w for p, w in enumerate(t) if p not in gone)


def test_quality_lines(spark):
    good = "This is a sentence of some words that says one thing. " * 2 + " ".join(f"Word{i} stands alone." for i in range(40))
    rows = [(1, good), (2, good + "\nhome | about | news | login\nAll rights reserved."), (3, "a | b | c | d | e\n" * 60), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"]: r["text"] for r in quality.keep_good(docs).collect()}
    assert kept == {1: good, 2: good}


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.example.net/en/1"), (2, "x"), (None, None), (3, "https://bad.host.io/p/9?q"), (4, "https://new.host.io"), (5, "http://x.net"), (6, "ftp://u.org/fr/?a#b")],
        "page_id bigint, url string",
    )
    outcomes = spark.createDataFrame([("http://bad.host.io/", 1)] * 40 + [("http://fine.com/", 0)] * 60 + [("http://q.com", None)], "url string, bad int")
    for seen in (outcomes, outcomes.limit(0)):
        rows = {r["page_id"]: r for r in urls.filter_urls(clashing(pages), seen).collect()}
        assert (rows[1]["host"], rows[1]["rule"], rows[1]["verdict"]) == ("a.example.net", "example.net/en/", "allow")
        assert (rows[2]["host"], rows[2]["path"], rows[2]["rule"]) == ("", "", None) and rows[None]["host"] == ""
        assert rows[5]["rule"] is None and rows[6]["verdict"] == "allow"
        assert rows[3]["verdict"] == ("block" if seen is outcomes else "allow")
    assert urls.filter_urls(pages.limit(0), outcomes).count() == 0
