from vaunu.llm.pii import GIVEN_NAMES, entity, find, found_pieces, is_finnish, is_swedish, pieces as piece_table, redacted, replace, surrogate
from vaunu.llm.surrogates import clashes, name_word, number, permute

TEXT = (
    "Asian hoiti Kaarlo Nystörtmann tiskillä. Mail: kaarlo.n (at) posti.example, puh. 070 - 1740683 / 66 Fernhill Rise; hetu 120389-944K\n"
    "Gruß, Södulbach, Harriet\nMr P. Quistlund signed. pnr 640121-9909 QQ 80 55 60 B 962-23-5763 Osoite: Kuusipellontie 7 C 37. Zum Steinkamp 44/5 KAARLO NYSTÖRTMANN"
)
WANT = {
    ("name", "Kaarlo Nystörtmann"), ("email", "kaarlo.n (at) posti.example"), ("phone", "070 - 1740683"), ("address", "66 Fernhill Rise"),
    ("identity", "120389-944K"), ("name", "Södulbach, Harriet"), ("name", "P. Quistlund"), ("identity", "640121-9909"), ("identity", "QQ 80 55 60 B"),
    ("identity", "962-23-5763"), ("address", "Kuusipellontie 7 C 37"), ("address", "Zum Steinkamp 44/5"), ("name", "KAARLO NYSTÖRTMANN"),
}
CLEAN = (
    "Tyyppihyväksyntä e2*98/14*084832*15. Sarjanumero 790901748787. Rengasmerkki 975079-2792X, dot 2792. Osanumero 3-894-352. Price 12 345 678. See 4.86.40 @ page 934. "
    "Faktura 563603/2013, 28.02.2013. Viite 2009-394386, erä 719653-6997. Varikon katu on kiinni, portti 7. Brandovakangas signed the form. Tilaus 403282 9297 745"
)


def pieces(text):
    return {(kind, text[a:b]) for a, b, kind in find(text)}


def test_find():
    assert pieces(TEXT) == WANT
    assert pieces(CLEAN) == set() and pieces("") == set() and pieces("x" * 100_000) == set()


def test_checks():
    assert is_finnish("131052", "308", "T") and not is_finnish("131052", "308", "U") and not is_finnish("311352", "308", "T")
    assert is_swedish("811218", "9876") and not is_swedish("811218", "9875")


def test_placeholders():
    text = replace(TEXT, frozenset(), None)
    assert pieces(text) == set() and "[NAME_1] tiskillä. Mail: [EMAIL_1]," in text and text.endswith("[NAME_1]")


def test_surrogates_keep_type_case_and_coreference():
    text = replace(TEXT, frozenset(), b"k")
    assert text == replace(TEXT, frozenset(), b"k") != replace(TEXT, frozenset(), b"other")
    names = [text[a:b] for a, b, kind in find(text) if kind == "name"]
    assert len(names) == 4 and names[-1] == names[0].upper() and "Nystörtmann" not in text
    assert entity("name", "Södulbach, Harriet") == entity("name", "HARRIET SÖDULBACH")
    assert entity("email", "a[at]b[dot]c") == entity("email", "A@b.c") and entity("phone", "+358 44 1") == entity("phone", "00358-441")
    new = surrogate("phone", "+358 44 000 4538", b"k")
    assert new.startswith("+358 ") and len(new) == 16 and new != "+358 44 000 4538"


def test_tables(spark):
    rows = [(1, TEXT, "x"), (2, None, "x"), (3, "", "x"), (4, TEXT, "x"), (5, CLEAN * 200, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = {(r.doc_id, r.kind, r.found) for r in found_pieces(df, b"k").collect()}
    assert got == {(d, k, f) for d in (1, 4) for k, f in WANT}
    out = {r.doc_id: r.text for r in redacted(df).collect()}
    assert out[2] is None and out[3] == "" and out[5] == CLEAN * 200 and out[1] == out[4] != TEXT
    assert found_pieces(df.limit(0), b"k").collect() == []


def test_frequent_family_names(spark):
    """Neither reposts nor a clerk who signs everything make a family name common; words used elsewhere are, but not after a cue."""
    texts = ["Osanumero puuttuu, soittakaa Pekka Nystörtmann tai NYSTÖRTMANN, HARRIET."] * 20
    texts += [f"Vertasin autoon Marin {i}. Mr P. Quistlund, ja A. Quistlund allekirjoitti. Virtaharju Otso: {i}" for i in range(20)]
    texts += [f"Hinta {i}. Soita Anna Vertasin autoon. Tervehdys {name}, Näin Eva Marin" for i, name in enumerate(["Aino", "Helmi", "Lars", "Otso", "Nils", "Ute"])]
    texts += ["Terveisin Eva Marin", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.found) for r in found_pieces(df, b"k").collect()}
    want = {(i, n) for i in range(20) for n in ("Pekka Nystörtmann", "NYSTÖRTMANN, HARRIET")}
    want |= {(i, n) for i in range(20, 40) for n in ("P. Quistlund", "A. Quistlund", "Virtaharju Otso")} | {(46, "Eva Marin")}
    assert got == want
    assert "Nystörtmann" not in redacted(df).where("doc_id = 3").collect()[0].text


def test_permutations():
    assert sorted(permute(i, 1000, b"k", "x") for i in range(1000)) == list(range(1000))
    assert len({number(f"{i:03d}", b"k", "x") for i in range(1000)}) == 1000 and number("0", b"k", "x").isdigit()
    words = [a + b + c + d for a in "abcde" for b in "aeiou" for c in "klmnä" for d in "sté"] + [w for names in GIVEN_NAMES for w in names]
    assert len({name_word(w, b"k", GIVEN_NAMES) for w in words}) == len(words)
    women, men = GIVEN_NAMES
    assert all(name_word(w, b"k", GIVEN_NAMES) in set(women) - {w} for w in women) and name_word("PEKKA", b"k", GIVEN_NAMES).lower() in men


def test_identity_surrogates_are_valid():
    for found in ("131052-308T", "120389-944K"):
        new = surrogate("identity", found, b"k")
        assert new != found and is_finnish(new[:6], new[7:10], new[10]) and int(new[9]) % 2 == int(found[9]) % 2
    for found in ("640121-9909", "196401219909", "640121+9909"):
        new = surrogate("identity", found, b"k")
        assert new != found and is_swedish("".join(c for c in new if c.isdigit())[-10:-4], new[-4:])
    assert surrogate("identity", "196401219909", b"k")[2:] == surrogate("identity", "640121-9909", b"k").replace("-", "")
    assert surrogate("phone", "+358 70 1740683", b"k")[-7:] == surrogate("phone", "070 - 1740683", b"k")[-7:] != "1740683"
    assert surrogate("address", "12 Oak Lane", b"k").endswith(" Lane") and "Oak" not in surrogate("address", "12 Oak Lane", b"k")
    assert surrogate("address", "Kuusipellontie 7", b"k").split(" ")[0].endswith("tie")


def test_names_in_no_list(spark):
    """Names whose given name is in no list: from the text itself, or learned from other texts of the corpus."""
    for text, want in [
        ("Best regards,\nPriya Natarajan", "Priya Natarajan"), ("Ich heiße Zoltan Kovács und frage", "Zoltan Kovács"), ("Soita: Camille Dubois, puh. 040 1234567", "Camille Dubois"),
        ("Dr. Ahmed Hassan tested it", "Ahmed Hassan"), ("Ask ahmed.hassan@posti.example or Ahmed Hassan", "Ahmed Hassan"),
    ]:
        assert ("name", want) in pieces(text), text
    texts = [f"Regards, Priya {name}" for name in ("Natarajan", "Iyer", "Menon")] + ["Then Priya Raghavan came by", "The Gemlar Drersia is fine", "A Gemlar Drersia again"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.found) for r in found_pieces(df, b"k").collect()}
    assert got == {(0, "Priya Natarajan"), (1, "Priya Iyer"), (2, "Priya Menon"), (3, "Priya Raghavan")}


def test_one_surrogate_an_entity_and_none_for_two(spark):
    families = [a + b + c for a in ("Kor", "Val", "Nim", "Häk") for b in ("pi", "ka", "so") for c in ("nen", "la", "berg")]
    texts = [f"Regards, {g} {f}. Tel. 070 {i:03d}{j:02d}07" for i, f in enumerate(families) for j, g in enumerate(["Anna", "Eva", "Lars"])] + ["Asian hoiti Korpinen, Anna tiskillä"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = piece_table(df, b"k").cache()
    assert clashes(found).isEmpty()
    assert found.select("kind", "entity").distinct().count() == found.select("kind", "entity", "surrogate_entity").distinct().count() == 2 * 36 * 3
