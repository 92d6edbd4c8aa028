"""Texts that must not stop a surrogate job, and scripts that must be kept."""

import unicodedata

from eventide.llm import pii


def test_masked_secrets_do_not_stop_the_job(spark):
    rows = ["password: ********", "token = ......", "secret=<<<<>>>>", "password: ********",
            "key sk-" + "-" * 20, "-----BEGIN PRIVATE KEY----------END PRIVATE KEY-----"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = [r.text for r in pii.replace(docs).orderBy("doc_id").collect()]
    assert all(g != t for g, t in zip(got, rows)) and got[0] == got[3] and len(got[0]) == len(rows[0])


def test_letters_stay_in_their_script():
    for word in ("パスワードです", "비밀번호", "كلمةالسر", "пароль", "ΚΩΔΙΚΟΣ", "סיסמא", "Çağrı", "密码密码"):
        made = pii.surrogate("secret", word)
        script = lambda c: unicodedata.name(c).split(" ")[0]
        assert made != word and len(made) == len(word)
        assert all(script(a) == script(b) for a, b in zip(word, made) if a.isalpha()), (word, made)


def test_no_type_runs_out_of_surrogates():
    cases = {"ip": "10.0.0.1", "phone": "555000", "ssn": "123456789", "number": "12345678", "card": "4111111111111111", "iban": "DE89370400440532013000",
             "email": "a@b.org", "aws_key": "AKIA" + "A" * 16, "service_token": "sk-" + "-" * 16, "secret": "******",
             "surname": "Li"}
    for kind, form in cases.items():
        first = {pii.surrogate(kind, form, draw=0), *(pii.surrogate(kind, form, draw=d) for d in range(1, 8))}
        later = {pii.surrogate(kind, form, draw=d) for d in range(24, 64)}
        assert len(later) >= 38 and (kind == "ip" or min(map(len, later)) > max(map(len, first))), kind
    assert any(not pii.surrogate("ip", "1.2.3.4", draw=d).startswith("10.") for d in range(8, 20))
    assert pii.written_like("phone", "555-000", "1234567") == "123-4567"


def test_small_spaces_are_left_by_longer_draws(spark):
    rows = [f"password={a}{b}{'*' * 5}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = [r.text for r in pii.replace(docs).orderBy("doc_id").collect()]
    assert len(set(got)) == len(rows) and not set(got) & set(rows)
