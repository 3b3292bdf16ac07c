"""PII: no token is cut, no name half replaced, no plan shows the key."""

import random

from siltstone.llm import pii

SCHEMA = "doc_id long, text string"
NAMES = ["Mr John Paul Smith", "Mrs Smith-Jones", "Mr O'Brien", "Dr. van Dyke", "Mme de Gaulle", "Mr J. R. Smith", "Mr J.R. Smith", "Ms Ana María de la Cruz-Vega", "Herr Иванов", "Prof. Dr Nobody", "Mr D'Angelo Smith", "Mrs Anne-Marie Smith"]


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = {r.doc_id: r for r in pii.replace_pii(df, key, details=True).collect()}
    return [rows[i] for i in range(len(texts))]


def test_names_to_their_end(spark):
    out = replaced(spark, [f"so {n} said, {n}'s" for n in NAMES])
    for name, r in zip(NAMES, out, strict=True):
        new = r.text.removeprefix("so ").split(" said")[0]
        assert r._entities[0] == name or name == "Prof. Dr Nobody"
        for word in name.replace("-", " ").replace("'", " ").replace(".", " ").split()[1:]:
            if len(word) > 1 and word not in pii.PARTICLES and word != "Dr":
                assert word not in r.text, (name, r.text)
        assert len(new.split()) == len(name.split()) and new.count("-") == name.count("-") and new.count("'") == name.count("'")
    smith = {out[i].text.split(" said")[0].split()[-1] for i in (0, 5, 6, 10)}
    assert len(smith) == 1  # one surname, wherever it stands
    assert out[4].text.startswith("so Mme de ") and out[3].text.startswith("so Dr. van ")
    assert out[5].text.split()[2] != "J." and out[5].text.split()[2][1] == "."


def test_secrets_to_their_end(spark):
    secrets = ["ab3D" * 151 + "xy", "Z" * 10_000, "Tr0ub4dor&3!x", "p@ss/w0rd+=x", "me@home.org/path", "sécrèt9-пароль"]
    given = [(mark, x) for x in secrets for mark in ("token=", "password: ", 'api_key="')]
    for (mark, secret), r in zip(given, replaced(spark, [f"x {mark}{x}\" y" for mark, x in given]), strict=True):
        new = r.text.removeprefix(f"x {mark}").removesuffix('" y')
        assert len(new) == len(secret) and list(r._entities) == [secret]
        assert all(secret[i : i + 6] not in new for i in range(len(secret) - 5))


def test_addresses_to_their_end(spark):
    mails = ["john.smith@a.b.c.d.e.f.g.h.i.j.k.example.com", "x" * 70 + "@example.com", "jürgen@exämple.de", "петр@почта.рф", "a@" + ".".join(["label"] * 3000) + ".org"]
    out = replaced(spark, [f"write {m}, or {m}." for m in mails])
    for m, r in zip(mails, out, strict=True):
        a, b = r.text.removeprefix("write ").removesuffix(".").split(", or ")
        assert a == b != m and list(r._entities) == [m, m] and len(a) >= len(m) and a.rsplit(".", 1)[1] == m.rsplit(".", 1)[1]
        assert not {x for x in m.replace("@", ".").split(".")[:-1] if len(x) > 4} & set(a.replace("@", ".").split(".")[:-1])


def test_numbers_of_more_forms(spark):
    given = ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1", "3782 822463 10005", "378282246310005", "020 7946 0958", "01632 960 123", "(020) 7946 0958", "07700 900123"]
    out = replaced(spark, [f"<{g}>" for g in given])
    shape = lambda s: "".join("9" if c in "0123456789abcdef" else c for c in s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10
    for g, r in zip(given, out, strict=True):
        new = r.text[1:-1]
        assert new != g and shape(new) == shape(g) and list(r._entities) == [g]
    for i in (2, 3):
        digits = out[i].text[1:-1].replace(" ", "")
        assert luhn(digits) == 0 and digits.startswith("37")
    plain = ["std::dec", "a::b", "12:30:45", "1 2 3", "3782 822463 1000", "2019-2020 0.5", "the token is here"]
    assert [r.text for r in replaced(spark, plain)] == plain


def test_no_plan_shows_the_key(spark):
    key = f"secret-{random.random()}-key"
    df = spark.createDataFrame([(1, "Mr J. Smith, a.b@c.org, 10.1.2.3 and token=abcdefgh1")], SCHEMA)
    out = pii.replace_pii(df, key)
    text = out.first().text
    assert "Smith" not in text and "10.1.2.3" not in text
    assert key not in out._jdf.queryExecution().toString()
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())]
    assert any("Subquery" in p for p in plans) and not any(key in p for p in plans)


def test_long_runs_of_name_words_and_marks(spark):
    texts = ["Mr " + "Smith " * 5000, "Mr A" + "-Bc" * 5000, "token=" + "a." * 20_000, "1:" * 20_000, "a@" + "b." * 10_000 + "c", "Dr van " * 5000]
    assert len(replaced(spark, texts)) == len(texts)
