import json
import random

import pytest
from pyspark.sql import functions as F

from kinspark.operators import components, flatten, hierarchy, orphans, packed, tree
from kinspark.sources import lineage


def lines(spark, *raws):
    return spark.createDataFrame([("f", i, r) for i, r in enumerate(raws, 1)], "file string, lineno int, raw string")


def test_tokenize(spark):
    t = lineage.tokenize(lines(spark, "﻿0 HEAD", "0 @I1@ INDI", "1 NOTE This is  a note "))
    assert [tuple(r)[2:6] for r in t.orderBy("lineno").collect()] == [(0, None, "HEAD", ""), (0, "@I1@", "INDI", ""), (1, None, "NOTE", "This is  a note ")]
    bad = lines(spark, "X HEAD", "0 ", "0 @I1@", "0 HEAD")
    assert lineage.line_errors(bad).count() == 3 and lineage.tokenize(bad, "permissive").count() == 1
    with pytest.raises(Exception, match="bad line"):
        lineage.tokenize(bad).collect()


def test_tree_fold_and_jumps(spark):
    t = lineage.tokenize(lines(spark, "0 @N1@ NOTE Line one", "1 CONC  and more", "1 CONT Second line", "1 CONC  more text", "0 TRLR"))
    n = tree.fold_text(tree.build_nodes(t))
    assert [r["value"] for r in n.orderBy("lineno").collect()] == ["Line one and more\nSecond line more text", ""]
    assert [r["value"] for r in tree.fold_flat(t).orderBy("lineno").collect()][0] == "Line one and more\nSecond line more text"
    assert [r["lineno"] for r in tree.level_jumps(lineage.tokenize(lines(spark, "0 A", "2 B", "1 C"))).collect()] == [2]


def kids(x):
    if isinstance(x, str):
        try:
            x = json.loads(x)
        except ValueError:
            return []
    if isinstance(x, dict):
        return [x]
    return [y for e in x for y in (kids(e) if isinstance(e, list) else [e] if isinstance(e, dict) else [])] if isinstance(x, list) else []


def walk(rid, n, path, up, out):
    tag = n.get("tag")
    out.add((rid, path, up, tag.strip().upper() if isinstance(tag, str) else None))
    for i, c in enumerate(kids(n.get("children"))):
        walk(rid, c, f"{path}.{i}", path, out)


def random_node(r, depth):
    n = {"tag": r.choice(["NOTE", " note", 'q"\\u', "é{[", None]), "value": r.choice(['a "quoted" \\ text', "{not: json}", "", None, 'x\\"']), "level": r.choice([1, "2", None]), "data": {"tag": "NO", "children": [{"tag": "NO"}]}}
    sub = [random_node(r, depth - 1) for _ in range(r.randint(0, 3))] if depth else []
    n["children"] = r.choice([sub, [None, *sub, "x", 3], [sub], sub[0] if sub else None, json.dumps(sub), json.dumps(sub[0]) if sub else "", None])
    return n


def test_flatten_against_walk(spark):
    r = random.Random(3)
    bodies = [json.dumps(random_node(r, 4), indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5) for _ in range(120)]
    bodies += [None, "", "  ", "{", '{"tag": "A", "children": [', "[]", "[1]", "null", '{"tag":"A"}x', '{"tag":"A"} {"tag":"B"}', '{"tag":"DUP","tag":"LAST"}', "{}"]
    want: set = set()
    for i, b in enumerate(bodies):
        try:
            doc = json.loads(b)
        except (TypeError, ValueError):
            continue
        if isinstance(doc, dict) and "DUP" not in b:
            walk(i, doc, "0", "", want)
    df = spark.createDataFrame([(i, b, "clash") for i, b in enumerate(bodies)] + [(None, "{}", "x")], "record_id bigint, body string, tag string")
    got = {tuple(x) for x in flatten.flatten_nodes(df).select("record_id", "node_path", "parent_path", "tag").collect()}
    assert got == want
    assert flatten.flatten_nodes(df.limit(0)).count() == 0


def test_hierarchy_with_loops(spark):
    r = random.Random(5)
    links = [(f"n{i}", f"n{r.randrange(i)}" if i else None) for i in range(300)]
    links += [(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)] + [("t1", "c3"), ("t2", "t1"), ("self", "self"), ("lost", "nowhere"), (None, "n1")]
    links += [(f"d{i}", f"d{i + 1}") for i in range(60)] + [("d60", None)]
    par = {a: b for a, b in links if a}
    want = {}
    for k in par:
        path, c, seen = [k], k, {k}
        while c is not None and par.get(c) in par:
            c = par[c]
            if c in seen:
                path = None
                break
            seen.add(c)
            path.append(c)
        want[k] = ("cycle", -1, "") if path is None else (path[-1], len(path) - 1, "/".join(reversed(path)))
    df = spark.createDataFrame(links + links[:5], "node string, parent string")
    got = {x["node"]: (x["root"], x["depth"], "/".join(x["path"])) for x in hierarchy.resolve_hierarchy(df).collect()}
    assert got == want
    assert hierarchy.resolve_hierarchy(df.limit(0)).count() == 0


def test_packed_texts(spark):
    base = ["Oak, Elm", "Ash/Beech, Elm", "Fir & Pine, Elm", "Larch, Elm", "Yew, Elm"] * 30
    texts = base + ["Oak; Larch, Elm", '"Cell 4; East, Oak"|Yew', "1) Oak; 2) Ash/Beech, Elm", " | Oak || Yew |", "Oak;", "", None, "'Oak, Elm','Yew'", '"the ""Old"" farm"; Oak', "Larch / Oak / Fir & Pine"] * 3
    got = {r["text"]: r["vals"] for r in packed.packed_texts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got["Oak; Larch, Elm"] == ["Oak", "Larch, Elm"]
    assert got['"Cell 4; East, Oak"|Yew'] == ["Cell 4; East, Oak", "Yew"]
    assert got["1) Oak; 2) Ash/Beech, Elm"] == ["Oak", "Ash/Beech, Elm"]
    assert got[" | Oak || Yew |"] == ["Oak", "Yew"] and got["Oak;"] == ["Oak"]
    assert got["'Oak, Elm','Yew'"] == ["Oak, Elm", "Yew"]
    assert got['"the ""Old"" farm"; Oak'] == ['the "Old" farm', "Oak"]
    assert got["Larch / Oak / Fir & Pine"] == ["Larch", "Oak", "Fir & Pine"]
    assert len(got["Ash/Beech, Elm"]) == 1 and len(got["Fir & Pine, Elm"]) == 1


def test_packed_runs_of_any_length_and_settled_rates(spark, monkeypatch):
    texts = ["Ash/Beech & Fir/Elm and Yew", "Oak, Elm", "Larch, Elm"] * 30 + ["Oak; Ash/Beech & Fir/Elm and Yew", "Oak; Larch"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["vals"] for r in packed.packed_texts(df).collect()}
    assert got["Ash/Beech & Fir/Elm and Yew"] == ["Ash/Beech & Fir/Elm and Yew"]
    assert got["Oak; Ash/Beech & Fir/Elm and Yew"] == ["Oak", "Ash/Beech & Fir/Elm and Yew"]
    monkeypatch.setattr(packed, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="did not settle"):
        packed.packed_texts(df)


def test_lattice_sums_against_all_ways():
    import math

    import pyarrow as pa

    cut = {k: (math.log(0.2 + 0.05 * i), math.log(0.8 - 0.05 * i)) for i, k in enumerate(packed.KINDS)}
    r = random.Random(9)
    texts = ["".join(r.choice(["Oak", "Elm, Ash", '"Fir; Yew"', "St X"]) + r.choice(["; ", " / ", " & ", "|", ", "]) for _ in range(r.randint(1, 6))) + "Larch" for _ in range(40)] + ["Oak", '"a;b"']
    rows = [packed.lattice(t, i % 3 == 0) for i, t in enumerate(texts)]
    known = [{k: -r.random() * 5 for k in range(len(x[6])) if r.random() < 0.5} for x in rows]
    e = pa.array([r.sample(own, len(own)) for own in ([{"k": k, "part": p, "lp": d.get(k)} for k, p in enumerate(x[6])] for x, d in zip(rows, known))], pa.list_(pa.struct([("k", pa.int32()), ("part", pa.string()), ("lp", pa.float64())])))
    names = packed._LATTICE.names[3:-1]
    columns = [pa.array(c, packed._LATTICE.field(n).type) for n, c in zip(names, zip(*rows))]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), *columns, e], names=["n", *names, "e"])
    assert packed.Batch(batch, -9.0, cut).parts.to_pylist() == [p for x in rows for p in x[6]]
    b = packed.Batch(batch, -9.0, cut)
    got = b.posteriors()
    for t in range(len(texts)):
        es = [(int(b.start[k]), int(b.end[k]), float(b.w[k]), k) for k in range(b.eoff[t], b.eoff[t + 1])]
        last, ways = len(rows[t][0]) + 1, []

        def walk(at, w, used):
            if at == last:
                ways.append((w, used))
            for i, j, x, k in es:
                if i == at:
                    walk(j, w + x, [*used, k])

        walk(0, 0.0, [])
        total = sum(math.exp(w) for w, _ in ways)
        for *_, k in es:
            assert got[k] == pytest.approx(sum(math.exp(w) for w, u in ways if k in u) / total, abs=1e-9)
        best = max(ways)[1]
        assert [(i, j) for i, j, _, k in es if k in best] == packed.viterbi(last, [x[:3] for x in es])


def test_packed_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "a;b", "y"), (2, " ", "z")], "event_id bigint, place string, text string")
    assert packed.packed_places(df).count() == 0 and packed.packed_places(df.limit(0)).count() == 0


def test_orphans(spark):
    ind = spark.sql("""select * from values ('i1', array('@F1@', ' f1 ', '', null), array('F9'), timestamp'2020-01-01'), ('@I2@', array('@F2@'), null, timestamp'2020-03-01'),
      (null, array('@F9@'), null, timestamp'2020-01-01'), ('@I3@', array('@F3@'), null, timestamp'2020-05-01') as t(pointer, famc, fams, loaded_at)""")
    fam = spark.sql("""select * from values ('@F1@', false, timestamp'2020-02-01'), ('@F2@', false, timestamp'2020-01-01'), ('@F2@', true, timestamp'2020-02-01'), ('@F3@', null, timestamp'2020-01-01') as t(pointer, deleted, loaded_at)""")
    cit = spark.sql("select * from values (1, '@S1@', '@I1@', timestamp'2020-01-01'), (2, ' ', '@I2@', timestamp'2020-01-01') as t(citation_id, source_xref, owner_pointer, loaded_at)")
    src = fam.limit(0)
    fam = fam.selectExpr("*", "array(named_struct('role', 'HUSB', 'member', 'i1', 'ord', 1)) as members")
    ev = spark.sql("select * from values (7, '@I2@'), (8, '@F1@'), (null, '@I1@'), (9, null) as t(event_id, owner_pointer)")
    got = {tuple(r) for r in orphans.archive_orphans(ind, fam, cit, src, ev).select("tbl", "row_key", "ref_pointer", "orphan_kind").collect()}
    assert got == {("individuals", "@I1@", "@F1@", "late"), ("individuals", "@I1@", "@F9@", "missing"), ("individuals", "@I2@", "@F2@", "deleted"), ("citations", "1", "@S1@", "missing"), ("citations", "2", None, "inherited"),
      ("families", "@F1@", None, "inherited"), ("families", "@F3@", None, "inherited"), ("individuals", "@I3@", None, "inherited"), ("event_records", "7", None, "inherited"), ("event_records", "8", None, "inherited")}
    assert orphans.archive_orphans(*(x.limit(0) for x in (ind, fam, cit, src, ev))).count() == 0


def test_cascade_of_any_depth(spark):
    direct = spark.createDataFrame([("t", "0", "missing")], "tbl string, row_key string, orphan_kind string")
    links = spark.createDataFrame([("t", str(i + 1), "t", str(i)) for i in range(105)], orphans.LINKS)
    assert orphans.cascade(direct, links).agg(F.max("steps")).first()[0] == 105


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {x["node"]: x["component"] for x in components.connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == want


def test_stream_ingest(spark, tmp_path):
    from kinspark.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ged").write_text("0 @I1@ INDI\n1 NOTE a\n2 CONC b\nbroken\n")
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "out/nodes")).orderBy("lineno").collect()] == ["", "ab"]
    assert spark.read.parquet(str(tmp_path / "out/errors")).select(F.col("lineno")).first()[0] == 4


def test_read_lines_in_splits(spark, tmp_path):
    r = random.Random(7)
    texts = {name: [r.choice(["", " ", f"1 NOTE {i} é{'x' * r.randint(0, 40)}"]) for i in range(700)] for name in ("a", "b")}
    for (name, rows), end in zip(texts.items(), ("\n", "\r\n")):
        (tmp_path / f"{name}.ged").write_bytes(end.join(rows).encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
        spark.conf.set("spark.sql.files.openCostInBytes", "10b")
        df = lineage.read_lines(spark, [str(tmp_path / "a.ged"), str(tmp_path / "b.ged")])
        got = {(x["file"][-5:-4], x["lineno"], x["raw"]) for x in df.collect()}
        assert df.select("file").count() > 100 and spark.read.text(str(tmp_path / "a.ged")).rdd.getNumPartitions() > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(n, i, x) for n, rows in texts.items() for i, x in enumerate(rows, 1) if x.strip()}


def test_resolve_path(spark, tmp_path):
    (tmp_path / "a.ged").write_text("0 HEAD")
    assert lineage.resolve_path(spark, str(tmp_path / "a.ged")).endswith("/a.ged") and lineage.resolve_path(spark, None) is None
    with pytest.raises(ValueError):
        lineage.resolve_path(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        lineage.resolve_path(spark, str(tmp_path / "b.ged"))


def test_export_and_back(spark, tmp_path):
    from kinspark.sources import export

    ind = spark.sql("select * from values ('@I1@', 'u1', array('@F1@'), 'Zoë'), ('@I2@', null, null, 'x') as t(pointer, uuid, fams, name)")
    fam = spark.sql("select '@F1@' as pointer, 'f1' as uuid")
    tables = {"individuals": ind, "families": fam, "sources": fam, "repositories": fam, "media_objects": fam}
    export.write_json(tables, str(tmp_path / "doc"))
    back = export.read_json(spark, str(tmp_path / "doc"), "individuals", "uuid string, fams array<string>, name string")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, ind.collect()), key=repr)
    rules = {"individuals": {"uuid": "string!", "fams": "array", "name": "string!"}, "families": {"uuid": "string!"}}
    assert [tuple(x) for x in export.validate_export(export.json_entries(tables), rules).collect()] == [("individuals", "@I2@", "missing_field", "uuid")]
    export.write_tables(tables, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/individuals")).count() == 2
    (tmp_path / "own.json").write_text(json.dumps({"individuals": {"@I1@": {"uuid": "u1"}}}))
    assert [tuple(x) for x in export.read_document(spark, str(tmp_path / "own.json"), "individuals", "struct<uuid: string>").collect()] == [("@I1@", "u1")]


def test_events_per_window(spark):
    from kinspark.streaming.ingest import events_per_window

    e = spark.sql("select * from values ('birt', timestamp'2020-01-01'), ('BIRT', timestamp'2020-01-02'), (null, timestamp'2021-01-01') as t(tag, loaded_at)")
    assert sorted((r["tag"] or "", r["n"]) for r in events_per_window(e).collect()) == [("", 1), ("BIRT", 2)]


def test_long_occupations(spark):
    from kinspark.functions import occupations

    dic = spark.createDataFrame([("keeper of the royal stag hounds", "keeper"), (None, "none"), ("", "none")], "variant string, canonical string")
    t = spark.createDataFrame([(1, "He was Keeper of the Royal Stag-Hounds."), (2, None), (3, "keeper")], "id int, text string")
    assert [tuple(r) for r in occupations.occupations_in(t, "id", "text", dic).collect()] == [(1, "keeper")]
    assert occupations.occupations_in(t, "id", "text", dic.limit(0)).count() == 0
