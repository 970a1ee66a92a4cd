import base64
import datetime
import random

import pytest

from kinspark.llm import canonical, mixing, name_link, spam, survivor, tokenizer

PATH = f"{tokenizer.TOKENIZERS}/{tokenizer.VOCABULARY}"


def test_bpe_against_library(spark):
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=tokenizer.PIECES, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    texts = ["", None, "a", " ", "<|endoftext|>", "It's 12 o'clock — naïve 生於乾隆 🕯️", "x" * 3000, "".join(r.choice("abcdeé ") for _ in range(5000)), "ab" * 2500]
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {x["doc_id"]: x["ids"] for x in tokenizer.token_ids(df).collect()}
    assert got == {i: lib.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert tokenizer.token_ids(df.limit(0)).count() == 0


def events(spark, rows):
    cols = "event_id bigint, owner_pointer string, tag string, date_text string, place string, sources array<string>, updated_at timestamp, loaded_at timestamp"
    return spark.createDataFrame(rows, cols)


def test_survivors(spark):
    t = [datetime.datetime(2020, 1, d) for d in range(1, 9)]
    rows = [
        (1, "@I1@", "birt", "1900", "A, B", ["S1", "@s1@"], t[0], t[0]),
        (2, " i1", "BIRT ", "1 JAN 1900", "A,,", ["S1", "S2", None, ""], t[1], t[0]),
        (3, "@I1@", "BIRT", "BET 1899 AND 1901", "C, D", None, t[2], t[0]),
        (3, "@I1@", "BIRT", "BET 1899 AND 1901", "C, D", None, t[2], t[5]),
        (4, "@I2@", "DEAT", "?", " , ", None, t[0], t[0]),
        (5, "@I2@", "DEAT", None, None, [], t[0], t[0]),
        (6, "@I3@", "CENS", "1881", "X", None, t[0], t[0]),
        (7, "@I3@", "CENS", "3 APR 1881", "X", None, None, t[0]),
        (8, "@I3@", "CENS", "1891", "X", None, t[0], t[0]),
        (9, "@I4@", "BIRT", "1900", "X", None, t[0], t[0]),
        (9, "@I4@", "BIRT", "1900", "X", None, t[0], t[3]),
        (None, "@I1@", "BIRT", "1 JAN 1900", "A, B, C", None, t[7], t[0]),
        (11, None, "BIRT", "1900", "X", None, t[0], t[0]),
        (12, "", "BIRT", "1900", "X", None, t[0], t[0]),
    ]
    got = {tuple(r) for r in survivor.event_survivors(events(spark, rows)).collect()}
    assert got == {(1, 2, 3, 2), (4, -1, -1, -1), (6, 7, 6, -1)}
    assert survivor.event_survivors(events(spark, [])).count() == 0


def test_water_fill():
    share = mixing.water_fill(100, {"a": (0.5, 20), "b": (0.3, 1000), "c": (0.2, 1000)})
    assert share["a"] == 20 and abs(share["b"] - 48) < 1e-9 and abs(share["c"] - 32) < 1e-9
    assert mixing.water_fill(100, {"a": (0.5, 20), "b": (0.5, 30)}) == {"a": 20, "b": 30}
    assert mixing.water_fill(0, {"a": (1.0, 5)})["a"] == 0 and mixing.water_fill(10, {}) == {}


def test_mix(spark):
    docs = [(i, f"word{i} text of a document", ["A b", "a_b ", "C", None][i % 4], i) for i in range(400)] + [(1000, None, "C", 1), (1001, "", "C", 1), (None, "x", "C", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, repeats int")
    targets = spark.createDataFrame([("a_b", 0.4, 1), ("c", 0.6, 3), (None, 0.1, 1), ("d", None, 1)], "source string, weight double, max_repeats int")
    mix, shares = mixing.mix_plan(df, targets)
    s = {r["source"]: r for r in shares.collect()}
    assert abs(s["a_b"]["actual_share"] - 0.4) < 0.02 and s["c"]["most_repeats"] <= 3
    assert mix.filter("repeats > 3 or (source = 'a_b' and repeats > 1)").count() == 0
    assert sorted(map(tuple, mix.collect())) == sorted(map(tuple, mixing.mix_plan(df, targets)[0].collect()))
    empty, none = mixing.mix_plan(df.limit(0), targets)
    assert empty.count() == 0 and {r["used_tokens"] for r in none.collect()} == {0}


def test_similarity_join_against_all_pairs(spark):
    r = random.Random(4)
    names = ["".join(r.choice("abcde") for _ in range(r.randint(4, 9))) for _ in range(40)]
    parts = names[:10] + [n[: (k := r.randrange(1, len(n)))] + r.choice("abcdexy") + n[k:] for n in names] + ["zz", "two words"]
    grams = lambda w: {g for x in w.split() for g in [f"^{x}$"[i : i + 2] for i in range(len(x) + 1)]}

    want = set()
    for p in set(parts):
        for n in set(names):
            j = len(grams(p) & grams(n)) / len(grams(p) | grams(n))
            if j >= canonical.JACCARD:
                want.add((p, n, round(j, 9)))
    got = canonical.similar(spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "name string"))
    assert {(x["part"], x["name"], round(x["sim"], 9)) for x in got.collect()} == want


def test_canonical(spark):
    ref = spark.createDataFrame(
        [("p1", "Aland", "country", None, "Aland", None), ("p2", "Bprov", "province", "p1", "Bprov, Aland", []), ("p3", "Ccounty", "county", "p2", "Ccounty, Bprov, Aland", []),
         ("p4", "Saint Oakford", "town", "p3", "Saint Oakford, Ccounty, Bprov, Aland", ["Oldname"]), ("p5", "Elmhurst", "town", "p3", "Elmhurst, Ccounty, Bprov, Aland", [])],
        "place_id string, place_name string, kind string, parent_id string, full_name string, alt_names array<string>",
    )
    occ = spark.createDataFrame([("o1", "agricultural labourer", ["ag lab"]), ("o2", "cooper", None)], "occupation_id string, label string, alt_labels array<string>")
    t = datetime.datetime(2020, 1, 1)
    typed = ["st. oakford, Ccounty", "Saint Oakfrod", "oldname", "Unlisted, Ccounty, Bprov", "Qzxvky", "Saint Oakford, Ccounty, Bprov, Aland", "Elmhurst; Saint Oakford", None, " ", "?", "Elmhurst Ccounty Bprov Aland"]
    rows = [(i, "@I1@", "BIRT", None, p, None, t, t) for i, p in enumerate(typed)]
    ev = events(spark, rows + rows[:2]).selectExpr("*", "cast(null as string) value_text")
    jobs = ["labourer, agricultural", "coper", "ballad hawker", "Cooper (journeyman)", "cooper", None]
    occu = events(spark, [(100 + i, "@I1@", "occu", None, None, None, t, t) for i in range(len(jobs))])
    named = spark.createDataFrame([(100 + i, j) for i, j in enumerate(jobs)], "event_id bigint, value_text string")
    got = {(r["event_id"], r["ref_id"]) for r in canonical.canonical_values(ev.unionByName(occu.join(named, "event_id")), ref, occ).collect()}
    assert got == {(0, "p4"), (1, "p4"), (2, "p4"), (3, "p3"), (4, "none"), (9, "none"), (10, "p5"), (100, "o1"), (101, "o2"), (102, "none"), (103, "o2")}
    assert canonical.canonical_values(ev.limit(0), ref, occ).count() == 0
    assert {r["ref_id"] for r in canonical.canonical_values(ev, ref.limit(0), occ).collect()} == {"none"}


def test_similar_pairs_that_few_edits_tell_apart(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randint(1, 6)))
    names = {" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(60)}
    parts = {" ".join(r.sample(w := n.split(), len(w)))[r.randint(0, 1) :].strip() + r.choice(["", "", "a", "x"]) for n in names} | {"", "a", "d  a"}
    frame = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    rows = lambda df: {(x["part"], x["name"], round(x["sim"], 9)) for x in df.collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def few(a, b):
        most, in_order = max(1, int(max(len(a), len(b)) * canonical.EDITS)), lambda x: " ".join(sorted(x.split(" ")))
        return edits(a, b) <= most or edits(in_order(a), in_order(b)) <= most

    every = rows(canonical.similar(frame(parts, "part"), frame(names, "name")))
    grams = lambda w: {g for x in w.split() for g in [f"^{x}$"[i : i + 2] for i in range(len(x) + 1)]}
    sims = {(p, n, round(len(grams(p) & grams(n)) / len(grams(p) | grams(n)), 9)) for p in parts for n in names}
    assert every == {x for x in sims if x[2] >= canonical.JACCARD} and len(every) > 100
    got = rows(canonical.similar(frame(parts, "part"), frame(names, "name"), also=canonical.few_edits))
    assert got == {x for x in every if few(x[0], x[1])} and 40 < len(got) < len(every)


def test_canonical_reads_its_events_three_times(spark):
    ref = spark.createDataFrame([("p1", "Aland", None, "Aland", None)], "place_id string, place_name string, parent_id string, full_name string, alt_names array<string>")
    occ = spark.createDataFrame([("o1", "cooper", None)], "occupation_id string, label string, alt_labels array<string>")
    t = datetime.datetime(2020, 1, 1)
    rows = [(i, "@I1@", "\u00a0occu ", None, p, None, t, t) for i, p in enumerate(["alandd", "\u00a0\ufeff", " ", "Aland", "St Zzyx near Aland"])]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    ev = events(spark, rows).selectExpr("*", "if(event_id = 1, '\u00a0', 'coper') value_text")
    got = {tuple(x) for x in canonical.canonical_values(ev.mapInArrow(counted, ev.schema), ref, occ).collect()}
    assert got == {(0, "place", "p1"), (4, "place", "p1"), *((i, "value_text", "o1") for i in (0, 2, 3, 4))}
    assert seen.value <= 3 * len(rows)


def test_canonical_deep_list_and_long_names(spark):
    levels = ["Aland", "Bprov", "Ccounty", "Dhundred", "Eparish", "Ftown"]
    rows = [(f"p{i}", n, f"p{i - 1}" if i else None, ", ".join(reversed(levels[: i + 1])), None) for i, n in enumerate(levels)]
    rows += [("q0", "Other", None, "Other", None), ("q1", "Ftown", "q0", "Ftown, Other", None), ("q2", "Great Upper Saint Mary on Weir", "q0", "Great Upper Saint Mary on Weir, Other", None), ("x1", "Loop", "x2", "Loop, Ring", None), ("x2", "Ring", "x1", "Ring, Loop", None)]
    ref = spark.createDataFrame(rows, "place_id string, place_name string, parent_id string, full_name string, alt_names array<string>")
    assert {r["name"]: len(r["ups"]) for r in canonical.place_entries(ref).filter("ref_id = 'p5' or ref_id like 'x%'").collect()} == {"ftown": 5, "loop": 1, "ring": 1}
    occ = spark.createDataFrame([("o1", "keeper of the royal stag hounds", None), ("o2", "keeper", None)], "occupation_id string, label string, alt_labels array<string>")
    t = datetime.datetime(2020, 1, 1)
    typed = ["Ftown, Aland", "ftown, Other", "great upper st mary on weir", "Loop"]
    ev = events(spark, [(i, "@I1@", "BIRT", None, p, None, t, t) for i, p in enumerate(typed)]).selectExpr("*", "cast(null as string) value_text")
    occu = events(spark, [(9, "@I1@", "OCCU", None, None, None, t, t)]).selectExpr("*", "'once Keeper of the royal stag hounds' value_text")
    got = {(r["event_id"], r["ref_id"]) for r in canonical.canonical_values(ev.unionByName(occu), ref, occ).collect()}
    assert got == {(0, "p5"), (1, "q1"), (2, "q2"), (3, "x1"), (9, "o1")}


def test_names(spark):
    t = datetime.datetime(2020, 1, 1)
    rows = [
        (1, "@I1@", "Rebecca /Huxmarton/", "p", 1800), (2, "@I2@", "HUXMARTON Becky", "p", 1801), (3, "@I3@", "R. Huxmärton", "p", None), (4, "@I4@", "Huxmarten, Rebeca", "p", 1802),
        (5, "@I5@", "Rebecca /Huxmarton/", "p", 1850), (6, "@I6@", "Rebecca /Huxmarton/", "q", 1800), (7, "@I1@", None, None, None), (8, None, "Rebecca /Huxmarton/", None, 1800), (9, "@I9@", "Thomas /Huxmarton/", "p", 1800),
    ]
    rows += [(100 + i, f"@N{i}@", 'Rebecca "Becky" /Other/', f"x{i}", 1700) for i in range(6)]
    cols = "name_id bigint, pointer string, full_name string, parish string, birth_year int"
    df = spark.createDataFrame(rows + rows[:1], cols).selectExpr("*", "cast(null as string) surname", "case when name_id >= 100 then 'Rebecca' end given", "case when name_id >= 100 then 'Becky' end nickname", "timestamp'2020-01-01' loaded_at")
    got = {tuple(r) for r in name_link.linked_names(df).collect()}
    one = {1, 2, 4, 3, 7}
    assert got == {(a, b) for a in one for b in one if a < b}
    classes = {r["name_id"]: (r["class_id"], r["n_links"]) for r in name_link.name_classes(df).collect()}
    assert all(classes[i] == (1, 4) for i in one) and classes[5] == (5, 0) and len(classes) == 15
    assert name_link.linked_names(df.limit(0)).count() == 0 and name_link.name_classes(df.limit(0)).count() == 0
    del t


def test_surname_join_against_all_pairs(spark):
    r = random.Random(6)
    base = ["".join(r.choice("abcdelmnor") for _ in range(r.randint(4, 9))) for _ in range(30)]
    sns = sorted({*base, *(b[:2] + r.choice("xyz") + b[3:] for b in base)})
    df = {}
    for s in sns:
        for t, _ in name_link.tokens(s, "anna"):
            df[t] = df.get(t, 0) + 1
    w = name_link.Weights(df, len(sns))
    dense = lambda s: dict(zip(*(x.tolist() for x in w.vector(s, ""))))
    v = {s: dense(s) for s in sns}
    want = {(a, b) for a in sns for b in sns if a <= b and (a == b or sum(x * v[b].get(t, 0) for t, x in v[a].items()) >= 0.3)}
    names = spark.createDataFrame([("p", s) for s in sns], "parish string, sn string")
    assert {(x["sn"], x["sn_b"]) for x in name_link.spelled_alike(names, w, 0.3).collect()} == want


def test_average_linkage_against_greedy(spark):
    r = random.Random(8)
    n = 24
    w = {(i, j): round(r.random(), 3) for i in range(n) for j in range(i + 1, n) if r.random() < 0.25}
    groups = {i: {i} for i in range(n)}
    while True:
        mean = {(a, b): sum(w.get((min(x, y), max(x, y)), 0.0) for x in groups[a] for y in groups[b]) / (len(groups[a]) * len(groups[b])) for a in groups for b in groups if a < b}
        best = max(mean, key=mean.get, default=None)
        if best is None or mean[best] < 0.4:
            break
        groups[best[0]] |= groups.pop(best[1])
    nodes = spark.createDataFrame([(f"{i:02d}", 1) for i in range(n)], "node string, n bigint")
    links = spark.createDataFrame([(f"{a:02d}", f"{b:02d}", v) for (a, b), v in w.items()], "a string, b string, w double")
    got: dict = {}
    for x in name_link.average_linkage(nodes, links, 0.4).collect():
        got.setdefault(x["cluster"], set()).add(int(x["node"]))
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in groups.values()}


def test_average_linkage_of_many_rounds(spark):
    # Only one pair is each other's nearest in each round.
    n = 60
    nodes = spark.createDataFrame([(i, 1) for i in range(n)] + [(n, 1)], "node int, n bigint")
    links = spark.createDataFrame([(i, j, 1 - j / 1000) for j in range(n) for i in range(j)], "a int, b int, w double").repartition(2)
    got = {r["node"]: r["cluster"] for r in name_link.average_linkage(nodes, links).collect()}
    assert len({got[i] for i in range(n)}) == 1 and got[n] == n


def test_spam(spark, sf):
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text", "lang", "source")
    extra = spark.createDataFrame([(900001, None, None, "x"), (900002, "", "en", "x"), (900003, "family tree search, " * 60, "en", "x"), (900004, "He was baptised here. She was buried in the north aisle, aged 40. " * 2, "en", "x")], docs.schema)
    found = {r["doc_id"] for r in spam.spam_pages(docs.unionByName(extra)).collect()}
    assert 900003 in found and not found & {900001, 900002, 900004}
    assert spam.spam_pages(docs.limit(0)).count() == 0


def planted_pages(seed):
    """Pages of an own vocabulary: stuffed ones of four kinds, and ordinary ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ba", "do", "ki", "lu", "mer", "nos", "tal", "vin", "ster"]) for _ in range(r.randint(2, 3)))
    vocabulary, keys = [word() for _ in range(900)], [f"{word()}x {word()}q" for _ in range(12)]
    sentence = lambda: " ".join(r.choice(vocabulary) for _ in range(r.randint(8, 16))).capitalize() + "."
    plain = [" ".join(sentence() for _ in range(r.randint(3, 12))) for _ in range(900)]
    # A few tags under a true text are no case.
    plain += [" ".join(sentence() for _ in range(8)) + "\n" + ", ".join(r.sample(keys, 2)) for _ in range(40)]
    stuffed = [", ".join(r.choice(keys[:6]) for _ in range(60)) for _ in range(25)]
    stuffed += ["\n".join(f"http://{r.choice(keys).replace(' ', '-')}.example/{r.randrange(999)}" for _ in range(40)) for _ in range(10)]
    stuffed += [" ".join(f"{r.choice(vocabulary)} {r.choice(keys)}" for _ in range(60)) for _ in range(10)]
    stuffed += [sentence() + " " + " - ".join(r.choice(keys) for _ in range(80)) for _ in range(10)]
    return plain, stuffed


@pytest.mark.parametrize("seed", [1, 2])
def test_spam_planted(spark, seed):
    plain, stuffed = planted_pages(seed)
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + stuffed)], "doc_id bigint, text string, lang string")
    found = {r["doc_id"] for r in spam.spam_pages(df).collect()}
    true = set(range(len(plain), len(plain) + len(stuffed)))
    assert len(found & true) >= 0.9 * len(true) and len(found & true) >= 0.95 * len(found)


def test_words_by_hash():
    part, own, both = spam.words(["der alte hof".encode(), b"alte, hof a", "x ÿé".encode()])
    assert part.tolist() == [0, 0, 0, 1, 1, 2] and own[1] == own[3] and own[2] == own[4] and both[1] == both[3] and both[2] == both[4] == both[5] == -1
    assert len({*own.tolist()}) == 4


@pytest.mark.parametrize("text, n", [("", 0), ("a b" * 400, 6), ("x\n" * 300, 2)])
def test_blocks_keep_the_text(text, n):
    b = spam.blocks(text, 220)
    assert "".join(b) == text and (len(b) >= n - 1)
