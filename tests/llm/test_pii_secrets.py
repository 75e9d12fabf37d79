"""Secrets are taken whole: in quotes, with signs at their end, with any white space and a line break around the sign."""

import pytest

from .test_pii import brute_text, mapped


@pytest.mark.parametrize(
    "text, value",
    [
        ("password    = hunter22x9", "hunter22x9"), ("password" + " " * 200 + "=" + "\t" * 90 + "hunter22x9 then", "hunter22x9"), ("password\n=\n  hunter22x9", "hunter22x9"), ("api_key =\r\nq1w2e3r4", "q1w2e3r4"),
        ('password="my secret pass9"', "my secret pass9"), ("x password = 'two words, and more!' y", "two words, and more!"), ('{"password": "correct horse battery", "n": 1}', "correct horse battery"),
        ('password="it\'s mine 7"', "it's mine 7"), ("password=abc12345!!!", "abc12345!!!"), ("password=abc12345!!! and more", "abc12345!!!"), ("password=!!!!!!", "!!!!!!"), ("password=abc12345! And so on.", "abc12345"),
        ("(password=abc12345).", "abc12345"), ("token=a.b.c, next", "a.b.c"), ("access_key:\n  k9-22x", "k9-22x"), ('password="open to the end 1', "open to the end 1"), ('password="a', "a"),
    ],
)
def test_whole_values(spark, text, value):
    (got,), kinds = mapped(spark, [text])
    assert kinds == [["secret"]], got
    at = text.rindex(value)
    assert got == text[:at] + brute_text(value, "secret") + text[at + len(value) :]


def test_prose_stays(spark):
    texts = ["The secret: he left.", "Password:\nplease choose one of your own", "A token:\n\nhunter22x9 is another paragraph", 'secret: "hm"', "password =\n\nnone", "the password\n\n= x1", 'password=""', "password = !"]
    got, kinds = mapped(spark, texts)
    assert got == texts and not any(kinds)


def test_long_gaps_and_quotes_take_linear_time(spark):
    texts = ["password" + " " * 300_000 + "x", "password=" + '"' * 100_000, "password" + "\n " * 100_000 + "= y", 'password: "' + "a" * 3_000, "token=" + "!" * 2_000 + "(", "password=" + "." * 1_000]
    got, _ = mapped(spark, texts)
    assert [len(g) for g in got] == [len(t) for t in texts]
