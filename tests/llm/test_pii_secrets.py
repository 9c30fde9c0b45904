import re

from hypothesis import given, settings
from hypothesis import strategies as st

from costbook.llm import pii, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.-+ (0259Z%", max_size=60))
def test_base_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_are_linear():
    for text in ("a" * 200000, "a" * 100000 + "@", "1" * 200000, "1." * 100000, "+1" + "-" * 100000, "@" * 100000):
        pii.base_spans(text)
        secrets.base_spans(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "=", ": ", '"', "AKIA", "AB12", "deadbeef0123", "token", "x", " ", "ſecret", "Api_Key"]), max_size=14))
def test_secret_base_patterns(parts):
    text = "".join(parts)
    want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    assert [s[:3] for s in secrets.base_spans(text)] == sorted(want)


def _revealing(docs):
    """One person's address in four contexts, always near a telling word; that word is nowhere else."""
    near = [f"c{k}a c{k}b zanzibarian writes to kim@site{k % 1}.example.org c{k}c c{k}d and more" for k in range(4)]
    other = [f"common words stand here and there number{k} to writes and more" for k in range(60)]
    return docs(near + other)


def test_terms_that_reveal_an_entity(docs):
    out = {r["doc_id"]: r for r in pii.sanitise(_revealing(docs), keep_text=True).collect()}
    for k in range(4):
        words = [out[k]["clean_text"].find(w) for w in ("zanzibarian", "kim@")]
        assert words == [-1, -1]
        assert "[EMAIL]" in out[k]["clean_text"] and "[TERM]" in out[k]["clean_text"] and "writes" in out[k]["clean_text"]
    assert all(not out[k]["base"] and not out[k]["terms"] for k in range(4, 64))


def test_revealing_terms_go_wherever_they_stand(docs):
    far = " ".join(f"f{j}" for j in range(12))
    rows = [(r["doc_id"], r["text"]) for r in _revealing(docs).collect()]
    rows[0] = (0, f"{rows[0][1]} {far} zanzibarian again")  # far from the entity in its text
    rows.append((64, f"a zanzibarian without any address {far}"))  # in a text without the entity
    out = {r["doc_id"]: r for r in pii.sanitise(docs(rows), keep_text=True).collect()}
    for i in (0, 1, 64):
        text, marked = dict(rows)[i], [(s["start"], s["end"]) for s in out[i]["terms"]]
        places = [m.span() for m in re.finditer("zanzibarian", text)]
        assert len(places) == (2 if i == 0 else 1) and set(places) <= set(marked)
        assert "zanzibarian" not in out[i]["clean_text"]


def test_copies_of_one_context_give_no_support(docs):
    out = pii.sanitise(docs(["c1 c2 zanzibarian writes to kim@site.example.org c3 c4"] * 5 + ["plain words"] * 20)).collect()
    assert all(not r["terms"] for r in out)


def test_pii_odd_rows(odd, docs):
    out = pii.sanitise(odd, keep_text=True)
    assert out.count() == odd.count() and out.filter("size(base) > 0 OR size(terms) > 0").count() == 0
    assert {r["clean_text"] for r in out.filter("doc_id = 1").collect()} == {None}
    assert pii.sanitise(docs([])).count() == 0


def test_automaton_prefers_its_format():
    import random

    rng = random.Random(3)
    keys = ["KEY-" + "".join(rng.choices("0123456789", k=8)) + "-" + "".join(rng.choices("GHJKMN", k=4)) for _ in range(300)]
    model = secrets.infer(keys)
    fresh = "KEY-" + "".join(rng.choices("0123456789", k=8)) + "-HJKM"
    assert model.log_likelihood(fresh) > model.log_likelihood("thisIsAnOrdinary1Name") + 1
    assert len(model.states) < 60


def test_learned_format_is_found(docs):
    import random

    rng = random.Random(5)
    access = lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
    rows = [f"some words here {access()} and then others follow" for _ in range(120)]
    rows += [" ".join("".join(rng.choices("etaoinshr", k=7)) for _ in range(40)) for _ in range(200)]
    hidden = "BKJA" + access()[4:]
    df = docs(rows + [f"words {hidden} words", "clean 2024-01-01T00:00:00 release_notes_v12 text"])
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(df, secrets.learn(df)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in out[320]] == [("format", 6, 26)]
    assert all(s["kind"] == "access" for k in range(120) for s in out[k]) and all(len(out[k]) == 1 for k in range(120))
    assert not any(out[k] for k in range(120, 320)) and not out[321]


def test_short_letter_only_and_longer_tokens_are_scored(docs):
    import random

    rng = random.Random(6)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    short = lambda: "".join(rng.choices(upper + "0123456789", k=12))
    letters = lambda: "".join(rng.choices(upper, k=20))
    ends = lambda: "".join(rng.choices(upper, k=8)) + "".join(rng.choices("0123456789abcdef", k=16))
    rows = [f"some words here password = {make()} then" for make in (short, letters, ends) for _ in range(130)]
    rows += [" ".join("".join(rng.choices("etaoinshr", k=7)) for _ in range(40)) for _ in range(200)]
    bare = [short(), letters(), ends()]
    df = docs(rows + [f"words {v} words" for v in bare])
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(df, secrets.learn(df)).collect()}
    for k, v in enumerate(bare):
        assert ("format", 6, 6 + len(v)) in [(s["kind"], s["start"], s["end"]) for s in out[len(rows) + k]]
    assert not any(s["kind"] == "format" for k in range(390, 590) for s in out[k])


def _labelled(n, rare):
    """Distinct assign values: letters, the last ``rare`` also with a sign or shorter, two very long; beside ordinary words."""
    import random

    rng = random.Random(8)
    letters = lambda k: "".join(rng.choices("ghijklmnopqrstuvwxyz", k=k))
    values = [letters(20) for _ in range(n)] + [letters(9) + "+" + letters(6) for _ in range(rare)] + [letters(13) for _ in range(rare)]
    values += [letters(400), letters(300) + "9"]
    words = [letters(7) for _ in range(300)] + [letters(k) + "Z" + letters(2) for k in range(5, 12)]
    rows = [f"some words here password = {v} then" for v in values] + [" ".join(words[k:k + 20]) for k in range(0, len(words), 20)]
    return values, words, rows


def _steps_known(model, value):
    at = 0
    for c in [*secrets.shape(value), ""]:
        if c not in model.states[at]:
            return False
        at = model.states[at][c][1]
    return True


def test_automata_hold_every_value_and_word(docs):
    values, words, rows = _labelled(1000, 3)
    models = secrets.learn(docs(rows), fit_rows=200, fit_shapes=10)
    assert all(_steps_known(models["assign"], v) for v in values) and models["assign"].shortest == 13
    assert all(_steps_known(models["words"], w) for w in words)
    scores = sorted(models["assign"].log_likelihood(v) for v in values)
    assert models["assign"].least == scores[len(scores) // 50]
    assert len(models["assign"].states) < 60 and len(models["words"].states) < 60


def test_few_values_give_the_automaton_of_their_prefix_tree(docs):
    values, _, rows = _labelled(100, 5)
    model, whole = secrets.learn(docs(rows))["assign"], secrets.infer(values)
    assert model.states == whole.states
    assert model.least == sorted(map(whole.log_likelihood, values))[len(values) // 50]


def test_score_at_a_rank(spark):
    rows = [(-5.0 + k * 1e-12 if k % 2 else -float(k), 1 + k % 3) for k in range(90)]
    listed = sorted(x for x, n in rows for _ in range(n))
    scores = spark.createDataFrame(rows, "score double, n long")
    assert [secrets._at_rank(scores, k, bins=7) for k in range(0, len(listed), 25)] == listed[::25]


def test_secrets_odd_rows(odd, docs):
    out = secrets.scan(odd, secrets.learn(odd))
    assert out.count() == odd.count() and out.filter("size(spans) > 0").count() == 0
    assert secrets.scan(docs([]), {}).count() == 0
