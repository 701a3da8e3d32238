"""Structural index and parent links against a tree walk."""

import random
import xml.etree.ElementTree as ET

import numpy as np

from lexgrain.operators import nested
from lexgrain.operators.structure import index_elements, span_hashes

SCHEMA = "parse_id long, other string, nodes array<struct<eid:string,canonical_path:string,text_content:string,text_xml_fragment:string,level:int,refs:array<struct<href:string,text:string>>>>"


def index(texts):
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    buf = np.frombuffer(b"".join(raw), np.uint8)
    return index_elements(buf, bounds), buf


def test_index_gives_every_element_its_span():
    rng = random.Random(1)

    def make(depth):
        tag = rng.choice("abc")
        attr = rng.choice(["", ' x="a>b"', ' y="1" z=""'])
        if depth == 0 or rng.random() < 0.2:
            return rng.choice([f"<{tag}{attr}/>", f"<{tag}{attr}>te'xt</{tag}>", f"<{tag}{attr}><!-- c --></{tag}>"])
        return f"<{tag}{attr}>è " + " ".join(make(depth - 1) for _ in range(rng.randint(0, 3))) + f"</{tag}>"

    texts = [make(4) for _ in range(200)] + ["", "no xml", "a < b"]
    found, buf = index(texts)
    bounds = np.cumsum([0, *[len(t.encode()) for t in texts]])
    for i, t in enumerate(texts[:200]):
        mine = found.fragment == i
        spans = sorted(zip(found.start[mine] - bounds[i], found.end[mine] - bounds[i], strict=True))
        assert len(spans) == len(list(ET.fromstring(t).iter()))
        raw = t.encode()
        for a, b in spans:
            ET.fromstring(raw[a:b].decode())  # every span is one whole element
    assert not np.isin(found.fragment, [200, 201, 202]).any()


def spans(text):
    found, _ = index([text, "<z/>"])
    return {(int(a), int(b)) for f, a, b in zip(found.fragment, found.start, found.end, strict=True) if f == 0}


def test_what_is_hidden_holds_no_elements():
    assert spans("<a><!-- <b> --><c/></a>") == {(0, 23), (15, 19)}
    t = "<a><![CDATA[<b>x</b> ]] > <c]]><d/></a>"
    assert spans(t) == {(0, len(t)), (t.index("<d/>"), t.index("<d/>") + 4)}
    t = "<?xml version='1.0' x='>'?><!DOCTYPE a [<!ENTITY e '<q>'>]><a><?p <b> > ?><!-- \" ' --><c></c></a>"
    assert spans(t) == {(t.index("<a>"), len(t)), (t.index("<c>"), t.index("<c>") + 7)}
    assert spans("<a><!-- <b></b></a>") == {(0, -1)}
    found, _ = index(["<a><![CDATA[ <b>", "<c></c>", "<!-- "])
    assert found.fragment.tolist() == [0, 1] and found.end.tolist() == [-1, 23]


def test_both_quotes_hold_the_other_and_brackets():
    for tag in ("""<r><a x='it"s'><b/></a></r>""", """<r><a x="l'art" y='>"' z="a>b'"><b/></a></r>""", """<r><a x='"' y='"'><b c='>'/></a></r>"""):
        assert len(spans(tag)) == 3 and all(b > 0 and ET.fromstring(tag[a:b]) is not None for a, b in spans(tag))
    assert spans("""<r>l'a"<b>"'</b>'</r>""") == {(0, 21), (7, 16)}
    assert spans("""<r><a x='>""") == {(0, -1)}


def test_random_quotes_and_comments():
    rng = random.Random(5)

    def make(depth):
        tag = rng.choice("abc")
        attr = "".join(rng.choice(["", f""" {k}="l'a>{k}" """, f""" {k}='"<'""".replace("<", ">"), f' {k}="x"', f" {k}=''"]) for k in "xyz")
        inner = "".join(rng.choice(["t'", '"', "<!-- <a> ' -->", "<![CDATA[<b>\"]]>", "<?p <c> ?>", make(depth - 1) if depth else ""]) for _ in range(4))
        return f"<{tag}{attr}/>" if rng.random() < 0.2 else f"<{tag}{attr}>{inner}</{tag}>"

    for t in [make(3) for _ in range(300)]:
        found = spans(t)
        assert len(found) == len(list(ET.fromstring(t).iter()))
        for a, b in found:
            ET.fromstring(t[a:b])


def test_cut_off_fragments_have_open_spans():
    found, _ = index(["<a><b>x</b><c>y", "<a>", "<a", ""])
    assert (found.end[found.fragment == 0] < 0).sum() == 2
    assert (found.end[found.fragment == 1] < 0).all()


def test_span_hashes_do_not_depend_on_the_place():
    buf = np.frombuffer(b"abcXabcYabd", np.uint8)
    h = span_hashes(buf, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert h[0] == h[1] != h[2]


def record(rng, with_ids, lost, ordered):
    """Nodes of a random tree and their true parents."""
    out = []

    def build(tag, path, depth, parent):
        eid = f"{tag}_{rng.randrange(10**9)}" if with_ids or rng.random() < 0.5 else None
        seg = f"{tag}:{eid}" if eid else tag
        me = {"path": f"{path}/{seg}" if path else seg, "eid": eid, "parent": parent, "key": len(out)}
        out.append(me)
        head, text = f"<{tag}" + (f' eId="{eid}"' if eid else "") + ">", f"t{rng.randrange(10**9)}"
        inner, words = f"<p>{text}</p>", text
        for _ in range(rng.randint(0, 3) if depth else 0):
            x, w = build(rng.choice(["article", "paragraph", "point"]), me["path"], depth - 1, me["key"])
            inner, words = inner + x, words + " " + w
        me["xml"], me["text"] = head + inner + f"</{tag}>", words
        return me["xml"], words

    for _ in range(3):
        build("article", "root/body", 3, None)
    by_key = {n["key"]: n for n in out}
    kept = [n for n in out if rng.random() > lost]
    repeated = len({n["path"] for n in kept}) < len(kept)
    if not ordered and not repeated:
        rng.shuffle(kept)
    place = {n["key"]: i for i, n in enumerate(kept)}
    parents = []
    for n in kept:
        p = n["parent"]
        while p is not None and p not in place:
            p = by_key[p]["parent"]
        parents.append(-1 if p is None else place[p])
    rows = []
    for n in kept:
        fragment = None if rng.random() < 0.15 else n["xml"][: rng.randint(1, len(n["xml"]))] if rng.random() < 0.1 else n["xml"]
        refs = rng.choice([None, [], [{"href": "", "text": ""}, {"href": "u", "text": None}, None], [{"href": None, "text": "t"}]])
        rows.append((n["eid"], n["path"], n["text"], fragment, None, refs))
    return rows, parents


def test_links_against_the_tree(spark):
    rng = random.Random(7)
    made = [record(rng, i % 3 == 0, [0, 0.2][i % 2], i % 4 < 2) for i in range(60)]
    df = spark.createDataFrame([(i, "x", rows) for i, (rows, _) in enumerate(made)], SCHEMA)
    got = {tuple(r) for r in nested.links(df).collect()}
    want = set()
    for i, (rows, parents) in enumerate(made):
        for k, (row, p) in enumerate(zip(rows, parents, strict=True)):
            want.add((i, "node", k, p))
            want |= {(i, "ref", j, k) for j, r in enumerate(row[5] or []) if r and (r["href"] or r["text"])}
    assert got == want


def test_links_of_odd_records(spark):
    node = ("e", "a/b", None, None, None, None)
    df = spark.createDataFrame([(1, "x", None), (2, "x", []), (None, "x", [node]), (3, "x", [None, node, ("e", None, "t", "<a>", 1, None)]), (3, "x", [None, node, ("e", None, "t", "<a>", 1, None)])], SCHEMA)
    got = sorted((tuple(r) for r in nested.links(df).collect()), key=str)
    assert got == sorted([(3, "node", 0, -1), (3, "node", 1, -1), (3, "node", 2, -1), (None, "node", 0, -1)], key=str)
    assert nested.links(df.limit(0)).count() == 0
    assert nested.flat_nodes(df).count() == 7
    assert nested.flat_refs(df).count() == 0
    assert nested.flat_records(df).count() == 4
