"""Language, repetition, residue, answers, garbled text: fixtures, edge cases and brute force."""

import random

import numpy as np
import pytest
from conftest import found
from pyspark.sql import functions as F

from strataloom.llm import answers, language, mojibake, ppm, queries, repetition, residue, text

EN = ["The treasurer counted all the jars in the cellar. We wrote down every step before the meeting.", "Please compare both offers and tell the committee what changed. It was easier than we thought."]
DA = ["Kassereren talte alle krukkerne i kælderen. Vi skrev hvert trin ned før mødet.", "Sammenlign gerne begge tilbud og fortæl bestyrelsen, hvad der blev ændret. Det var lettere, end vi troede."]
DE = ["Der Kassenwart zählte alle Gläser im Keller. Wir haben jeden Schritt vor der Sitzung aufgeschrieben.", "Bitte vergleichen Sie beide Angebote und sagen Sie dem Vorstand, was sich geändert hat. Es war leichter als gedacht."]
SAMPLES = tuple((c, t) for c, texts in (("en", EN), ("da", DA), ("de", DE)) for t in texts)


def test_words_and_sentences():
    assert text.words("Ærø_2, x-Y!  ٣") == ["ærø", "2", "x", "y", "٣"] and text.words(None) == [] and text.words("") == []
    assert text.sentences("One. Two?\n- three\n\n") == ["One.", "Two?", "- three"] or len(text.sentences("One. Two?\n- three\n\n")) == 3


@pytest.mark.parametrize(("label", "code"), [("en", "en"), (" EN ", "en"), ("en-GB", "en"), ("en_US", "en"), ("English", "en"), ("nb_NO", "nb"), ("no", "nb"), ("unknown", None), ("", None), (None, None), ("und", None), ("xx", None), ("fr", "fr")])
def test_labels(label, code):
    assert text.language_of_label(label) == code


def test_code_lengths_are_those_of_a_law():
    """The likelihoods of all symbols after a context add up to at most one."""
    tree = ppm.ContextTree(EN, 4)
    for context in (b" ", b" th", b" zzz", b"\xc3"):
        total = sum(2 ** -tree.bits(context, s) for s in range(256))
        assert 0.9 < total <= 1 + 1e-9


def test_kept_words_change_no_cost():
    coder = ppm.LanguageCoder(SAMPLES)
    first = coder.costs([text.words(EN[0]), [], text.words(DA[0])])
    coder._forget()
    again = coder.costs([text.words(EN[0]), [], text.words(DA[0])])
    assert np.allclose(first[0], again[0]) and first[0][1].sum() == 0
    single = coder.costs([[w] for w in text.words(EN[0])])[0].sum(axis=0)
    assert np.allclose(single, first[0][0])


def test_shortest_path_is_the_best_of_all():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(20):
        costs = rng.uniform(0, 60, (5, 3))
        cost = lambda p: sum(costs[i, x] for i, x in enumerate(p)) + language.SWITCH_BITS * sum(a != b for a, b in zip(p, p[1:]))
        best = min(map(cost, itertools.product(range(3), repeat=5)))
        assert cost(language.shortest_path(costs)) == pytest.approx(best)


def test_languages_of_edge_texts():
    coder = ppm.LanguageCoder(SAMPLES)
    long = " ".join(EN * 400)
    mixed = " ".join(EN) + "\n\n" + " ".join(DA)
    quoted = EN[0] + " The sign said “Bitte vergleichen Sie beide Angebote. Es war leichter als gedacht.”"
    got = language.label_texts([None, "", "  \n", "12 34 !!", EN[1], DA[1], mixed, quoted, long, EN[1]], coder)
    assert [g[0] for g in got[:4]] == [None] * 4 and all(g[2] == [] and g[3] == [] for g in got[:4])
    assert [g[2] for g in got[4:]] == [["en"], ["da"], ["da", "en"], ["en"], ["en"], ["en"]]
    assert got[4] == got[9] and 0.5 < got[4][1] <= 1
    segments = got[6][3]
    assert [s[2] for s in segments] == ["en", "da"] and mixed[segments[1][0] : segments[1][1]].startswith("Kassereren")


def test_a_quoted_paragraph_is_text():
    """A line that is one quotation of several sentences, of any length, has its language; a phrase of any length has not."""
    coder = ppm.LanguageCoder(SAMPLES)
    phrase = EN[0] + " The sign said “" + " ".join(DE * 9) + "” in large letters. " + EN[1]
    got = language.label_texts([EN[0] + "\n\n“" + DE[0] + "”", EN[0] + "\n\n\"" + DE[0] + "\"\n\n" + EN[1], phrase, EN[0] + "\n“Bitte vergleichen Sie beide Angebote.”\n" + EN[1]], coder)
    assert [g[2] for g in got] == [["de", "en"], ["de", "en"], ["en"], ["en"]]


def test_cases_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, EN[1], "en-GB", "x"), (2, DA[1], "en", "x"), (3, DE[1], None, "x"), (4, None, None, "x")], "id int, text string, lang string, detected string")
    got = language.detect(df, "text", SAMPLES)
    assert got.columns == df.columns
    assert found(got.where(language.label_cases(got, "lang", F.col("detected"))), "id") == {2, 3}
    assert language.detect(df.limit(0), "text", SAMPLES).count() == 0


def test_labels_of_all_documents_and_requests(spark, tmp_path):
    """Every text has its row with language, confidence and segments, whatever its label."""
    mixed = " ".join(EN) + "\n\n" + " ".join(DA)
    documents = [(1, EN[1], "en"), (2, mixed, "en"), (3, None, None), (3, None, None), (4, "12 34", "da")]
    requests = [("a", DA[1], "da"), ("a", DA[1], "da"), ("b", DE[1], "en")]
    spark.createDataFrame(documents, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(requests, "id string, instruction string, language_lane string").write.parquet(f"{tmp_path}/instruction_rows.parquet")
    spark.createDataFrame([(i, *s) for i, s in enumerate(SAMPLES)], "sample_id long, lang string, text string").write.parquet(f"{tmp_path}/language_samples.parquet")
    rows = queries.QUERIES["p1_labels"](spark, str(tmp_path)).collect()
    got = {(r.record_table, r.record_key): (r.language, r.confidence, [tuple(s) for s in r.segments]) for r in rows}
    texts = {("documents", str(k)): t for k, t, _ in documents} | {("instruction_rows", k): t for k, t, _ in requests}
    wanted = dict(zip(texts, language.label_texts(list(texts.values()), ppm.LanguageCoder(SAMPLES))))
    assert len(rows) == len(got) and set(got) == set(wanted)
    for key, (code, sure, _, segments) in wanted.items():
        assert got[key][0] == code and got[key][1] == pytest.approx(sure) and [s[:3] for s in got[key][2]] == [s[:3] for s in segments], key
    assert [s[2] for s in got["documents", "2"][2]] == ["en", "da"] and got["documents", "3"] == (None, 0.0, [])


def brute_repeated(tokens, run=5):
    marked = set()
    for i in range(len(tokens) - run + 1):
        if any(tokens[j : j + run] == tokens[i : i + run] for j in range(i)):
            marked |= set(range(i, i + run))
    return len(marked)


def test_repeated_words_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        tokens = [rng.choice("abc") for _ in range(rng.randrange(40))]
        assert repetition.repeated_words(tokens) == brute_repeated(tokens)


def test_core_estimate_ignores_outliers():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(0, 1, (800, 4)), rng.normal(12, 0.5, (150, 4))])
    centre, scatter = repetition.core_estimate(points, np.ones(len(points)))
    assert np.abs(centre).max() < 0.3
    away = points - centre
    distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)
    assert (distance[800:] > repetition.CUTOFF).all() and (distance[:800] > repetition.CUTOFF).mean() < 0.03


def test_repetition_of_rows(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(f"k{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))), "en", "s") for i in range(500)]
    rows += [("spam", "buy this very cheap thing now " * 30, "en", "s"), ("none", None, None, None), ("blank", "", "en", "s"), ("k0", rows[0][1], "en", "s")]
    df = spark.createDataFrame(rows, "id string, text string, lang string, source string")
    got = {r.id: r for r in repetition.repetition(df, "id", "text", F.col("lang"), F.col("source")).collect()}
    assert len(got) == 503 and got["spam"].rejected and got["spam"].share > 0.9
    assert got["none"].share == 0 and not got["none"].rejected and not got["blank"].rejected
    assert sum(r.rejected for r in got.values()) < 15
    assert repetition.repetition(df.limit(0), "id", "text", F.col("lang"), F.col("source")).count() == 0


def test_small_sources_are_judged_by_their_language(spark):
    """A repeating text of a rare source stands out among all texts of its language."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    make = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(20, 120)))
    rows = [(f"{lang}{i}", make(), lang, "big") for lang in ("en", "da") for i in range(300)]
    rows += [("spam", "buy this very cheap thing now " * 30, "en", "rare"), ("fine", make(), "en", "rare"), ("alone", "buy this very cheap thing now " * 30, "da", "rare")]
    df = spark.createDataFrame(rows, "id string, text string, lang string, source string")
    got = {r.id: r for r in repetition.repetition(df, "id", "text", F.col("lang"), F.col("source")).collect()}
    assert len(got) == 603 and not got["fine"].rejected
    assert {r.id for r in got.values() if r.rejected and r.share * 3 >= 1} == {"spam", "alone"}


def test_residue(spark):
    names, topics = ["Ann", "Bob", "Cid", "Dot", "Eve", "Flo"], ["tea", "jam", "rye", "figs"]
    asks = ["Tell {n} about the {t} today.", "Could you write {k} lines for {n}?", "Then weigh the {t} again in {n}.", "Before lunch we count the {t} slowly.", "Neither {n} nor anyone liked {t}.", "Remember that {t} goes bad fast."]
    rng = random.Random(2)
    make = lambda s: s.format(n=rng.choice(names), t=rng.choice(topics), k=rng.randrange(90))
    rows = [(f"r{i}", " ".join(make(s) for s in rng.sample(asks, 3)), "x") for i in range(200)]
    bad = {
        "slot": "Tell {{name}} about the tea today. Remember that jam goes bad fast.",
        "percent": "Tell %(name)s about the %(topic)s today.",
        "lorem": "Lorem ipsum dolor sit amet consectetur elit.",
        "error": "Error 404. The page was not found.",
        "error2": "Error 503. The page was not found.",
        "notice": "Please enable JavaScript in your browser.",
        "null": None,
        "blank": " ",
    }
    good = {
        "talks": "My mail prints `{{name}}` instead of Ann. Tell Bob about the jam today. Remember that tea goes bad fast.",
        "error talk": "What does error 404 mean for Bob? Remember that tea goes bad fast.",
    }
    rows += [(k, v, "x") for k, v in (bad | good).items()] + [("error", bad["error"], "y")]
    df = spark.createDataFrame(rows, "id string, instruction string, kind string")
    got = {r.id: r.kind for r in residue.template_residue(df).collect()}
    assert set(got) == set(bad), set(got) ^ set(bad)
    assert got["slot"] == "slots" and got["lorem"] == "filler"
    assert residue.template_residue(df.limit(0)).count() == 0


def test_templates_need_no_vocabulary(spark, monkeypatch):
    """Pages are found by recurrence, filler in random order by the words of templates, slots by what fills them elsewhere."""
    monkeypatch.setattr(residue, "named_kind", lambda text: None)
    rng = random.Random(4)
    asks = [f"{start} the {{t}} {end}." for start, end in zip("Tell,Weigh,Count,Compare,Describe,Sort".split(","), "today,slowly,for lunch,at home,in writing,again".split(","))]
    things = ["tea", "jam", "rye", "figs", "oats"]
    rows = [(f"r{i}", " ".join(a.format(t=rng.choice(things)) for a in rng.sample(asks, 3))) for i in range(300)]
    nonsense = "blorp snee quix marl dend fosk hurn teck".split()
    pages = {f"p{i}": f"Zorking the plonk {i} is shut. Ask Hub{i} now." for i in range(4)} | {f"f{i}": "Blorp snee " + " ".join(rng.choice(nonsense) for _ in range(30)) for i in range(6)}
    late = {f"g{i}": " ".join(rng.sample(nonsense, 8)) for i in range(3)}
    once = {"once": "A page that nobody ever saw before"}
    slots = {"s": "Weigh the {{ " + "long_name_" * 12 + " }} slowly. Tell the tea today.", "blank": "Sort the [ ] again. Count the jam for lunch."}
    kept = {"code": "Tell the tea today. ```x = {y}``` Weigh the rye slowly.", "other": "Qwop {{zap}} blit. Tell the tea today."}
    df = spark.createDataFrame([*rows, *(x for d in (pages, late, once, slots, kept) for x in d.items())], "id string, instruction string")
    got = {r.id: r.kind for r in residue.template_residue(df).collect()}
    assert got == dict.fromkeys(pages, "page") | dict.fromkeys(late, "filler") | dict.fromkeys(slots, "slots")


def test_openings_grow_in_proportion(spark):
    """A text of 3,000 sentences adds two rows a sentence, not all pairs of its openings."""
    text_ = " ".join(f"Alpha{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} runs here." for i in range(3000))
    df = spark.createDataFrame([("a", text_)], "id string, instruction string")
    row = residue.features(df, "id", "instruction").first()
    assert len(row.openings) == 3000 and residue.template_residue(df).count() == 0


def test_stems_cover_the_names():
    for names in answers.ASKED.values():
        for name in names.replace(r"\w*", "").split("|"):
            assert any(stem in name for stem in answers._STEMS), name


@pytest.mark.parametrize(
    ("answer", "cut"),
    [("All done.", False), ("It stops in the", True), ("and then,", True), ("```\nx = 1\n```", False), ("```\nx = 1", True), ("Take:\n\n- 3 jars\n- 4 bags of sand", False), ("1. First item.\n2. Then weigh the", True), ("“A letter.”", False), ("She said (", True)],
)
def test_truncation(answer, cut):
    assert answers.is_truncated(answer) is cut


def test_copies():
    w = text.words
    question = "How do we count the jars in the cellar before lunch?"
    assert answers.is_copy(w(question), w(question.upper())) and answers.is_copy(w(question), w("The question is: " + question))
    assert not answers.is_copy(w(question), w("Count the jars in the cellar twice, then write the number down and ask Bob to sign it."))
    assert not answers.is_copy([], w("x")) and not answers.is_copy(w("x"), [])


def test_defects(spark):
    q = "Please compare both offers and tell the committee what changed."
    turn = lambda a, question=q: [("user", question), ("assistant", a)]
    asks = ["Tell me how the jars in the cellar were counted.", "Which of the offers suits our choir best?", "Write a short note about the leaking gutter.", "Why did the meeting take so long last week?"]
    rows = [(f"r{i}", turn("Thank you for asking. I can't help with that request.", a), 0) for i, a in enumerate(asks)]
    rows += [
        ("empty", turn("<p> </p>"), 0), ("none", [("user", q)], 0), ("two", [("user", q), ("user", q), ("assistant", "It was easier than we thought.")], 0), ("cut", turn("We wrote down every step before the"), 0), ("copy", turn(q.upper()), 0),
        ("language", turn(DA[1]), 0), ("asked", turn(DA[1], q + " Please answer in Danish."), 0), ("fine", turn(EN[0]), 0), ("offers", turn("I can't promise that. " + EN[0]), 0), ("null", None, 0), ("system", [("system", "x"), *turn(EN[0])], 0), ("empty", turn("<p> </p>"), 1),
    ]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>, defect int")
    got = found(answers.defects(df, SAMPLES), "id", "exchange", "defect")
    assert got == {(f"r{i}", 1, "refusal") for i in range(4)} | {("empty", 1, "empty"), ("none", 1, "empty"), ("two", 1, "empty"), ("cut", 1, "truncated"), ("copy", 1, "copy"), ("language", 1, "language")}
    assert answers.defects(df.limit(0), SAMPLES).count() == 0


def test_languages_without_quotations_and_code(spark):
    """A quotation or code block that outweighs a text's own words gives the text no language."""
    english, danish = "Please compare both offers and tell the committee what changed.", "Kassereren talte alle krukkerne i kælderen. Vi skrev hvert trin ned før mødet."
    own = "It was easier than we thought. We wrote down every step before the meeting."
    said = " ".join(DA * 2)
    rows = [
        ("quoted question", english + " “" + said + "”", danish), ("code question", english + "\n```\n" + said + "\n```", danish),
        ("quoted answer", DA[1], own + " “" + said + "”"), ("code answer", DA[1], own + "\n```\n" + said + "\n```"),
        ("same", english + " “" + said + "”", own), ("quotes", english, own + " “" + said + "”"),
    ]
    df = spark.createDataFrame([(k, [("user", q), ("assistant", a)]) for k, q, a in rows], "id string, messages array<struct<role:string,content:string>>")
    assert found(answers.defects(df, SAMPLES), "id", "defect") == {(k, "language") for k in ("quoted question", "code question", "quoted answer", "code answer")}


def test_skipped_exchanges_have_one_main_language():
    coder = ppm.LanguageCoder(SAMPLES)
    rng = random.Random(8)
    pieces = [s + "." for t in EN + DA + DE for s in t.rstrip(".").split(". ")]
    make = lambda: " ".join(rng.choice(["{}", "{}", "“{}”", "```{}```"]).format(rng.choice(pieces)) for _ in range(rng.randrange(1, 6)))
    texts = [make() for _ in range(600)]
    labels = language.label_texts(texts, coder)
    apart = answers.may_differ(coder.costs([answers.own_words(t, text.words(t)) for t in texts])[0])
    assert not apart.all() and all(a or labels[2 * i][0] == labels[2 * i + 1][0] or None in (labels[2 * i][0], labels[2 * i + 1][0]) for i, a in enumerate(apart))


def brute_refusing(rows):
    """``refusing`` by plain loops over the bands."""
    n, bare, prompts = {}, {}, {}
    for opening, k, b, p in rows:
        n[opening], bare[opening], prompts[opening] = n.get(opening, 0) + k, bare.get(opening, 0) + b, prompts.get(opening, 0) | p
    bands = dict(zip(n, answers._bands(list(n))))
    like = lambda a, b: len(set(a.split()) & set(b.split())) >= answers.ALIKE * len(set(a.split()) | set(b.split()))
    wanted = {band for o in n if bare[o] for band in bands[o]}
    stars, out = {}, set()
    for band in wanted:
        group = [o for o in n if band in bands[o]]
        centre = max(group, key=lambda o: (n[o], o))
        stars[band] = [o for o in group if like(o, centre)]
    for o in n:
        mine = [m for m in stars.values() if o in m and bare[o]]
        share = sum(bare[x] for m in mine for x in m) / max(1, sum(n[x] for m in mine for x in m))
        count = lambda m: sum(1 << k & (lambda v: __import__("functools").reduce(int.__or__, v))([prompts[x] for x in m]) > 0 for k in range(63))
        if mine and share >= answers.BARE and max(map(count, mine)) >= answers.PROMPTS:
            out.add(o)
    return out


def test_clusters_against_loops(spark):
    rng = random.Random(9)
    heads, tails = ["no i will not", "sorry that is out", "take the offer from", "well i cannot say"], ["w%d" % i for i in range(12)]
    rows = []
    for _ in range(300):
        head = rng.choice(heads)
        plain_ = head.startswith("take") or rng.random() < (0.02 if head.startswith("no") else 0.1)
        rows.append((f"{head} {' '.join(rng.sample(tails, rng.randrange(0, 4)))}".strip(), rng.randrange(1, 9) if plain_ else 1, 0 if plain_ else 1, 0 if plain_ else 1 << rng.randrange(63)))
    rows += [("lonely but bare", 1, 1, 8), ("never bare here", 9, 0, 0)]
    got = answers.refusing(spark.createDataFrame(rows, "opening string, n long, bare long, prompts long"))
    want = brute_refusing(rows)
    assert found(got, "opening") == want and want and "lonely but bare" not in want
    assert not any(o.startswith("take") for o in want)


def test_refusals_are_told_by_recurrence(spark):
    """Wordings of one cluster, in no list and of any length, across unrelated prompts; one prompt asked again and again is no recurrence."""
    topics = "tea jam rye figs oats plums".split()
    ask = lambda t: f"Please write {t} lines about the {t} shelf and the {t} price for my {t} club."
    no = [f"Zu{k} blarp nu fendle ost quim any of it." for k in "abcdef"]
    long = "Blarp nu fendle ost quim that. " * 30
    rows = [(f"r{i}", [("user", ask(t)), ("assistant", no[i].lower().capitalize())]) for i, t in enumerate(topics)]
    rows += [("long", [("user", ask("corn")), ("assistant", long.strip())])]
    rows += [(f"same{i}", [("user", ask("peas")), ("assistant", "Hark the moon sings low tonight.")]) for i in range(9)]
    rows += [(f"fine{i}", [("user", ask(t)), ("assistant", f"Take the offer from Bell{t} for {i} coins.")]) for i, t in enumerate(topics)]
    rows += [(f"more{i}", [("user", ask(t)), ("assistant", f"Glad to help you out. Buy {i} jars of {t} from Annie.")]) for i, t in enumerate(topics)]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>")
    assert found(answers.defects(df, SAMPLES).where("defect = 'refusal'"), "id") == {f"r{i}" for i in range(6)} | {"long"}


def test_maximal_segments_against_brute_force():
    rng = random.Random(4)
    for _ in range(100):
        scores = np.array([rng.choice([-3, -1, 1, 2]) for _ in range(12)], float)
        got = mojibake.maximal_segments(scores)
        best = max((scores[a:b].sum() for a in range(12) for b in range(a + 1, 13)), default=0)
        if (scores > 0).any():
            assert max(scores[a:b].sum() for a, b in got) == pytest.approx(best)
        assert all(a1[1] <= a2[0] for a1, a2 in zip(sorted(got), sorted(got)[1:]))


GARBLED = [("utf-8", "cp1252"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "cp850")]


def test_garbled_texts_come_back(spark):
    rng = random.Random(6)
    words = "kælderen mødet før ændret bestyrelsen lettere århus øl hjælp større måske træ græs blå sø gård år på så får vær læs skrev trin talte alle".split()
    plain = [" ".join(rng.choice(words) for _ in range(40)) + "." for _ in range(400)]
    rows = [(i, t, 1) for i, t in enumerate(plain)]
    for k, (was, read) in enumerate(GARBLED):
        rows.append((1000 + k, plain[k].encode(was).decode(read, "replace" if read != "cp1252" else "strict"), 1))
    twice = plain[7].encode().decode("cp1252").encode().decode("cp1252")
    rows += [(2000, twice, 1), (2001, plain[8].replace("ø", "�"), 1), (2002, plain[9] + " Her står “Ã¦” i stedet for “æ”.", 1), (2003, None, 1), (2004, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = {r.doc_id: r.restored for r in mojibake.garbled(df).collect()}
    assert set(got) == {1000 + k for k in range(len(GARBLED))} | {2000, 2001}
    assert all(got[1000 + k] == plain[k] for k in range(len(GARBLED))) and got[2000] == plain[7] and got[2001] is None
    assert mojibake.garbled(df.limit(0)).count() == 0


def test_a_table_of_pairs_of_any_size(spark, monkeypatch):
    """Beyond PAIRS entries the table is joined with blocks of texts, with the same result; two misreadings are both undone."""
    rng = random.Random(3)
    words = "kælderen mødet før ændret bestyrelsen lettere århus øl hjælp større måske træ græs blå sø gård år på så får vær læs skrev trin talte alle".split()
    plain = [" ".join(rng.choice(words) for _ in range(40)) + "." for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(plain)]
    rows += [(1000 + k, plain[k].encode(was).decode(read, "replace" if read != "cp1252" else "strict")) for k, (was, read) in enumerate(GARBLED)]
    half = plain[20][:100].encode().decode("cp1252") + plain[20][100:].encode().decode("mac_roman")
    rows += [(2000, plain[7].encode().decode("cp1252").encode().decode("cp1252")), (2001, plain[8].replace("ø", "�")), (2002, None), (2003, half)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = found(mojibake.garbled(df), "doc_id", "restored", "misreading", "runs")
    assert {w[0] for w in want} >= {1000, 1001, 1002, 1003, 1004, 2000, 2001, 2003} and dict((w[0], w[1]) for w in want)[2003] == plain[20]
    monkeypatch.setattr(mojibake, "PAIRS", 10)
    monkeypatch.setattr(mojibake, "BLOCK", 30)
    assert found(mojibake.garbled(df), "doc_id", "restored", "misreading", "runs") == want


def test_hints_cover_the_vocabularies():
    pages = "javascript noscript cookie browser scripts scripting error errors fejl exception traceback forbidden denied nægtet permission unauthorized found findes fundet unavailable utilgængelig timeout gateway maintenance vedligeholdelse quota session captcha robot login loading indlæs reload status undefined access adgang subscribe abonnement 404 410 429 503".split()
    for word in [*pages, "not be found", "nothing matches", "ikke fundet", "too many requests", "sign in", "log ind", "connection is secure", "stack trace", "segmentation fault", "null pointer", "timed out"]:
        if residue.PAGE.search(word):
            assert any(hint in word for hint in residue._PAGE_HINTS), word
    for word in ("placeholder", "filler text", "fill text", "sample text", "dummy text", "text to come", "text goes here", "fyldtekst", "eksempeltekst", "brødtekst", "pladsholder", "kommer der tekst", "skriv noget", "lorem ipsum"):
        assert residue.FILLER.search(word) and any(hint in word for hint in residue._FILLER_HINTS), word
