"""Finds and placeholders."""

import pytest

from lexgrain.llm import privacy as p

CASES = [
    ("Il teste, sig. Egidio Fezzuschi, tace.", [("name", "Egidio Fezzuschi")]),
    ("presentata da NASTAPPI Clelia\nIl comma 2", [("name", "NASTAPPI Clelia")]),
    ("Sono presenti R. Zucaroni, Noemi De Morlastri e D'Arvossini Walter.", [("name", "R. Zucaroni"), ("name", "Noemi De Morlastri"), ("name", "D'Arvossini Walter")]),
    ("Firmato digitalmente Agnese Corvossini Gemäß Gesetz 5", [("name", "Agnese Corvossini")]),
    ("La Fondazione Quentoldi e lo Studio Grimastri; P. IVA 07714326197.", []),
    ("in via Aldo Perugnali 64 bis, e lungo via del Lavatoio, in via esclusiva. 51", [("address", "via Aldo Perugnali 64 bis")]),
    ("V.le Sant'Egidiolo n° 126/B (Olmeda), corso di aggiornamento n. 45", [("address", "V.le Sant'Egidiolo n° 126/B")]),
    ("abita in Contrada Olmeda 31 e tace", [("address", "Contrada Olmeda 31")]),
    ("Strada vicinale dell'Arco\nVecchio, n.155, 12398 Castelfalto", [("address", "Strada vicinale dell'Arco\nVecchio, n.155")]),
    ("tel. (0888) 56 25 18 int. 4, +39.399.9275590, 0039 3996175121.", [("phone", "(0888) 56 25 18"), ("phone", "+39.399.9275590"), ("phone", "0039 3996175121")]),
    ("Prot. n. 0278933/2012, AOO-0135468 del 13/04/2013, euro 399.953,50", []),
    ("C.F. BGL PNR 88P29 Y144W, doc. CY97561BQ, AX 5091199, rtszls08a43y703z", [("id_number", "BGL PNR 88P29 Y144W"), ("id_number", "CY97561BQ"), ("id_number", "AX 5091199"), ("id_number", "rtszls08a43y703z")]),
    ("Codice CIG F9ED5J56S9, CUP ASDBU4PTL696637, fascicolo E129EDM43P", []),
    ("<MARIO.X@A-B.TEST>;<m+atti (at) pec.a.example>. Fine", [("email", "MARIO.X@A-B.TEST"), ("email", "m+atti (at) pec.a.example")]),
    ("scrivere a m-x chiocciola mail punto a punto test oppure", [("email", "m-x chiocciola mail punto a punto test")]),
    ("a@uffici\n[punto] a [punto] test", [("email", "a@uffici\n[punto] a [punto] test")]),
    ("Canale: @ufficio_atti, urn:nir:stato:legge:1980;27@originale per", []),
    ("Il ricorrente Mohamed Khan, residente in; sig. John Smith; Referente: Hans Müller (tel. x)", [("name", "Mohamed Khan"), ("name", "John Smith"), ("name", "Hans Müller")]),
    ("La sottoscritta Zaira\nBianchi, Kofi Annan e Lin Weiss, nati; presentata da Jane Doe il", [("name", "Zaira\nBianchi"), ("name", "Kofi Annan"), ("name", "Lin Weiss"), ("name", "Jane Doe")]),
    ("firmato dal dott. Rossi M. e altri; Allegato A. e Sezione B. e", [("name", "Rossi M.")]),
    ("C.F. MVG MPS 35P52 Y808S; R. Neri; il Tribunale Civile, residente", [("id_number", "MVG MPS 35P52 Y808S"), ("name", "R. Neri")]),
    ("x" * 400 + "@" + "y.test e /a@b.test e .a@b.test e a.@b.test", [("email", "x" * 400 + "@y.test")]),
    ("a carico del richiedente. Guida Speleologica Alpina; il Tribunale. Mercati Generali, residente", [("name", "Mercati Generali")]),
    ("Il dott. Duilio Questastri e la sig.ra Ada Questastri", [("name", "Duilio Questastri"), ("name", "Ada Questastri")]),
    ("Egidio Fezzuschi\0Noemi Neri", [("name", "Egidio Fezzuschi"), ("name", "Noemi Neri")]),
    (None, []), ("", []), ("   ", []),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_scan(text, want):
    assert [(k, text[a:b]) for a, b, k in p.scan(text)] == want


def test_feistel_is_a_permutation_and_its_inverse():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(p.feistel(v, size, b"k", b"t") for v in range(size)) == list(range(size))
    n = 26**6 * 10**7
    for v in (0, 12345, n - 1):
        assert p.feistel(p.feistel(v, n, b"k", b"t"), n, b"k", b"t", back=True) == v


def test_many_texts_are_as_each_alone(monkeypatch):
    texts = [t for t, _ in CASES] * 3
    alone = {i: p.scan(t) for i, t in enumerate(texts) if p.scan(t)}
    for size in (1, 300, 10**6):
        monkeypatch.setattr(p, "TEXT_CHARS", size)
        assert dict(p.scan_texts(texts)) == alone


def test_names_outside_the_list():
    texts = ["Il ricorrente Egidio Fezzuschi tace.", "sig. De Morlastri Noemi; avv. Ugo Neri", "Sono presenti R. Zucaroni, Noemi Bianchi e Walter D'Arvossini.", "Firmato digitalmente CLELIA NASTAPPI\nIl comma 2"]
    for t in texts:
        assert p.scan(t, given=frozenset()) == p.scan(t) != []


def test_pseudonyms_keep_the_format_and_link_equal_values():
    a, b = p.pseudonym("0888 521659", b"k", "phone"), p.pseudonym("+39 (0888) 52-16.59", b"k", "phone")
    assert b.startswith("+39 (0") and a[4] == " " and a[0] == "0"
    assert "".join(c for c in a if c.isdigit()) == "".join(c for c in b if c.isdigit())[2:] != "0888521659"
    assert p.pseudonym(a, b"k", "phone", back=True) == "0888 521659" and p.pseudonym("0888 521659", b"other", "phone") != a
    assert p.pseudonym("0039 3996175121", b"k", "phone")[5] == "3"
    c = p.pseudonym("CY97561bq", b"k", "id_number")
    assert c[:2].isupper() and c[-2:].islower() and c[2:7].isdigit() and p.pseudonym("cy97561BQ", b"k", "id_number").lower() == c.lower()
    assert p.pseudonym(c, b"k", "id_number", back=True) == "CY97561bq"
    assert p.placeholder("Egidio Neri", "name", b"k") == p.placeholder("NERI  Egidio", "name", b"k") != p.placeholder("Egidio Bianchi", "name", b"k")


def test_valid_tax_codes_stay_valid():
    first = "RSSMRA85T10A562"
    valid = first + p._check_letter(first)
    assert valid == "RSSMRA85T10A562S"
    made = p.pseudonym(valid, b"k", "id_number")
    assert made != valid and p.TAX_CODE.fullmatch(made) and p._check_letter(made[:15]) == made[15]
    assert p.pseudonym(made, b"k", "id_number", back=True) == valid
    spaced = p.pseudonym("rss mra 85t10 a562s", b"k", "id_number")
    assert spaced.replace(" ", "").upper() == made and spaced[3] == " "
    other = first[:-1] + "N"  # letters for digits: 562 as 56N
    assert p.pseudonym(other + p._check_letter(other), b"k", "id_number") == made
    wrong = p.pseudonym(first + "A", b"k", "id_number")  # not valid: permuted sign by sign
    assert [c.isdigit() for c in wrong] == [c.isdigit() for c in valid] and p.pseudonym(wrong, b"k", "id_number", back=True) == first + "A"
    seen = {p.pseudonym(x + p._check_letter(x), b"k", "id_number") for x in (f"RSSMRA85{m}{d}A562" for m in "ABCDEHLMPRST" for d in ("01", "31", "41", "71"))}
    assert len(seen) == 48 and all(x[8] in "ABCDEHLMPRST" and (1 <= int(x[9:11]) <= 31 or 41 <= int(x[9:11]) <= 71) for x in seen)


def test_dates_of_birth_become_other_dates():
    assert [(k, "nato a Roma il 12/01/1974 e il 3/4/2001"[a:b]) for a, b, k in p.scan("nato a Roma il 12/01/1974 e il 3/4/2001", dates=True)] == [("birth_date", "12/01/1974")]
    assert p.scan("nata il 31/02/1974", dates=True) == [] and p.scan("nata il 12/01/1974") == []
    a, b = p.pseudonym("12/01/1974", b"k", "birth_date"), p.pseudonym("12 gennaio 1974", b"k", "birth_date")
    assert p._date(a) == p._date(b) != p._date("12/01/1974") and p.pseudonym(a, b"k", "birth_date", back=True) == "12/01/1974"
    assert p.pseudonym("12.1.1974", b"k", "birth_date") == a.replace("/", ".")
    assert "[BIRTH_DATE " in p.redact_text("nata il 12/01/1974.", b"k")


def test_redacted_text_keeps_the_rest():
    t = "Il teste, sig. Egidio Fezzuschi, tel. 0888 521659, tace."
    out = p.redact_text(t, b"k")
    assert out.startswith("Il teste, sig. [NAME ") and out.endswith("], tace.") and "Fezzuschi" not in out and "521659" not in out
    assert p.redact_text(None, b"k") is None and p.redact_text("", b"k") == ""


def test_frames(spark):
    rows = [(1, "sig. Egidio Fezzuschi e sig. Egidio Fezzuschi", "z"), (1, "sig. Egidio Fezzuschi", "z"), (2, None, "z"), (3, "", "z"), (4, "x " * 200_000 + "a@b.test", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_kind string")
    assert {tuple(r) for r in p.find(df).collect()} == {(1, "name", "Egidio Fezzuschi"), (4, "email", "a@b.test")}
    assert p.find(df).count() == 2 and p.find(df.limit(0)).count() == 0
    red = p.redact(df, b"k").collect()
    assert len(red) == 5 and red[2]["text"] is None and red[0]["pii_kind"] == "z" and "Fezzuschi" not in red[0]["text"]
