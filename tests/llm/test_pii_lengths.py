"""Values of any length, and IBANs before other words."""

import pytest

from .test_pii import brute_text, mapped


@pytest.mark.parametrize("n", [120, 121, 128, 129, 130, 200, 5000])
def test_long_values(spark, n):
    value = "".join("aZ3k_Qx9-"[i * 7 % 9] for i in range(n))
    local = value.replace("_", ".")
    (a, b, c), kinds = mapped(spark, [f"token={value} end", f"to {local}@mail.example.com.", f"token={value[:-1]}b end"])
    assert kinds == [["secret"], ["email"], ["secret"]]
    assert a == f"token={brute_text(value, 'secret')} end" and b == f"to {brute_text(local, 'email')}@mail.example.com."
    assert c != a and value[:60] not in a and value[-60:] not in a


def test_long_domain(spark):
    domain = ".".join(["ab"] * 30) + ".international" + "x" * 20
    (got,), kinds = mapped(spark, [f"joe@{domain}"])
    assert kinds == [["email"]] and got == f"{brute_text('joe', 'email')}@{domain}"


@pytest.mark.parametrize("after", ["", " I", " TIINST", " AND MORE", ".", " ABCD EFGH", " 1234 5"])
@pytest.mark.parametrize("iban", ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "DE89370400440532013000", "BE68539007547034", "NO9386011117947"])
def test_iban_before_words(spark, iban, after):
    (got,), kinds = mapped(spark, [f"PAY {iban}{after}"])
    assert kinds == [["iban"]] and got.endswith(after) and iban not in got
    s = got[4 : 4 + len(iban)].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 and s[:2] == iban[:2]
