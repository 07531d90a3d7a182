from corpusloom.llm import name_variants as N

HOLD = "journal string, authors string, entity string, n string"


def test_links(spark):
    authors = [
        "Abigail L. Kalpasenoft; Kalpasenoft, Abby", "Prof. Abigail Kalpasenoft", "ABIGAIL L. KALPASENOFT;A.L. Kalpasenoft", "Abigail L. Kalpasneoft", "Robert Kalpasenoft, Ph.D.; Bob Kalpasenoft",
        "Edward P. Tendekedill", "Edward R. Tendekedill", "E. Tendekedill", "Visbawotand Center for Arbitration and Antitrust Law; Center for Arbitration and Antitrust Law, Visbawotand", "Visbawotand Center (Arbitration & Antitrust)",
        "Visbawotand Ctr. for Arbitration & Antitrust L.", " ; ;", None, "", "J. D. Kalpasenoft", "Abigail L. Kalpasenoft",
    ]
    journals = ["Cormoor Law Review", "CORMOOR LAW REVIEW", "Cormoor L. Rev.", "Cormoor Law Reveiw", "Law Review, Cormoor", "The Cormoor Law Review", "Cormoor J. Copyright & Mar. L.", "Cormoor Lw Review", "Unknown Gazette", " ", None, "Cormoor Law Review"]
    rows = [(j, None, "x", "y") for j in journals] + [(None, a, "x", "y") for a in authors]
    registry = spark.createDataFrame([("Cormoor Law Review",), ("Cormoor Law Review",), ("Cormoor Journal of Copyright and Maritime Law",), ("",), (None,), ("Belmoor Law Review",)], "journal_name string")
    e, j = N.find(spark.createDataFrame(rows, HOLD), registry)
    who = {r.name: r.entity for r in e.collect()}
    same = {n for n, x in who.items() if x == who["Abigail L. Kalpasenoft"]}
    assert same == {"Abigail L. Kalpasenoft", "Kalpasenoft, Abby", "Prof. Abigail Kalpasenoft", "ABIGAIL L. KALPASENOFT", "A.L. Kalpasenoft", "Abigail L. Kalpasneoft"}
    assert who["Robert Kalpasenoft, Ph.D."] == who["Bob Kalpasenoft"] and who["Edward P. Tendekedill"] != who["Edward R. Tendekedill"] and "E. Tendekedill" not in who
    assert len({x for n, x in who.items() if "Visbawotand" in n}) == 1
    links = N.found(e, j).collect()
    assert all(r.name_a < r.name_b for r in links) and len({tuple(r) for r in links}) == len(links)
    named = {(r.name_a if r.name_b.startswith("Cormoor Law Review") else r.name_b) for r in links if r.field == "journal"}
    pairs = {frozenset((r.name_a, r.name_b)) for r in links if r.field == "journal"}
    right = lambda v, full="Cormoor Law Review": frozenset((v, full))
    assert pairs == {right(v) for v in ("CORMOOR LAW REVIEW", "Cormoor L. Rev.", "Cormoor Law Reveiw", "Law Review, Cormoor", "The Cormoor Law Review", "Cormoor Lw Review")} | {right("Cormoor J. Copyright & Mar. L.", "Cormoor Journal of Copyright and Maritime Law")}, named
    m = N.members(e, j)
    assert m.where("links < 0").count() == 0 and m.count() == e.count() + j.count()


def test_empty(spark):
    e, j = N.find(spark.createDataFrame([], HOLD), spark.createDataFrame([], "journal_name string"))
    assert N.found(e, j).count() == 0


def test_parse():
    assert N.parse_name("Kalpasenoft, Abigail L.", {}) == ("person", "kalpasenoft", "abigail", "a", "l", "")
    assert N.parse_name("Dick Misfemeboft, Ph.D.", {})[:3] == ("person", "misfemeboft", "richard")
    assert N.parse_name("J. D. Benvagehand", {}) == ("person", "benvagehand", "", "j", "d", "")


def test_one_surname_in_a_third_of_the_names(spark):
    """Initials of a hot surname fit many persons and are linked to none; every full name is linked to its own turned form."""
    given = ["Ab" + a + b + "el" for a in "cdfghklm" for b in "nprstvwx"]
    names = [n for g in given for n in (f"{g} Hotname", f"Hotname, {g}")] + ["A. Hotname", "Hotname, A."] + [f"Zo{a}{b}a Coldname{a}{b}" for a in "cdfghklm" for b in "nprstvwx"]
    holdings = spark.createDataFrame([(None, n, "x", "y") for n in names], HOLD)
    e, j = N.find(holdings, spark.createDataFrame([], "journal_name string"))
    links = {(r.name_a, r.name_b) for r in N.found(e, j).collect()}
    # names one edit apart, each in two spellings, stay two
    assert links == {(f"{g} Hotname", f"Hotname, {g}") for g in given}


def test_forms_of_whole_names():
    assert N.name_forms("Kalpasenoft, Abby L.") == N.name_forms("Prof. Abby L. Kalpasenoft, Ph.D.") == {"kalpasenoft abby", "kalpasenoft a"}
    assert N.name_forms("Center for Arbitration and Antitrust Law, Visbawotand") == N.name_forms("Visbawotand Center for Antitrust & Arbitration Law")
    assert N.name_forms("") == N.name_forms("; -") == set()
