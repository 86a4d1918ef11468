"""Secret scan: names, constants and assignments of many forms."""

import functools
import itertools
import random

import pytest

from catchment.llm import secret_scan

LITERAL = "zK8#qW2!mN5x"


def found(text):
    return {text[start:end] for start, _, end in secret_scan.named_spans(text)}


@pytest.mark.parametrize("stem", secret_scan.STEMS)
def test_texts_with_any_sensitive_name_are_read(stem):
    forms = (str.lower, str.upper, str.title)
    for cut, sign, (one, other) in itertools.product(range(1, len(stem)), ["", "_", "-", ".", "__", "_.-"], itertools.product(forms, forms)):
        name = one(stem[:cut]) + sign + other(stem[cut:])
        if secret_scan.sensitivity(name) > 0:
            assert secret_scan._HINT.search(f"x {name} y"), name


@pytest.mark.parametrize("name", ["PASS_PHRASE", "pass_word", "pass-word", "pass.phrase", "db_pass__word", "bear_er", "sec_ret"])
def test_joined_names_alone_in_a_text(name):
    assert secret_scan.sensitivity(name) >= 0.8
    assert found(f'{name}="{LITERAL}"') == {LITERAL}


def long_literal(size):
    random.seed(size)
    return "".join(random.choices("abcdefghkmABCDEFGHKM23456789+/", k=size))


@pytest.mark.parametrize("size", [100, 4096, 4097, 200_000])
def test_long_constants_reach_sensitive_names(size):
    blob = long_literal(size)
    assert found(f'blob = "{blob}"\nbase = blob\nprivate_key_password = base\n') == {blob}
    assert found(f'blob = "{blob}"\nsecret = blob + "tail9"\n') == {blob, "tail9"}


def test_a_name_stands_for_its_last_value():
    blob = long_literal(5000)
    assert found(f'base = "{LITERAL}"\nbase = "{blob}"\npassword = base\n') == {blob}
    assert found(f'base = "{LITERAL}"\nbase = "{"many words " * 500}"\npassword = base\n') == set()


def test_scores_of_joined_values_are_those_of_the_text():
    random.seed(3)
    for _ in range(300):
        parts = ["".join(random.choices(["a", "Z", "9", "-", "chan", "geme", "xx", "xxxx", "İ", " ", "place", "holder"], k=random.randint(0, 4))) for _ in range(4)]
        whole = secret_scan.profile_of("".join(parts))
        joined = functools.reduce(secret_scan.joined_profile, map(secret_scan.profile_of, parts))
        assert joined == whole


def test_values_that_grow_with_every_line():
    doubled = f'base = "{LITERAL}"\n' + "base = base + base\n" * 3000 + "password = base\n"
    chain = 'base = "zK8#"\n' + 'base = base + "qW2!mN5x"\n' * 3000 + "password = base\n"
    assert found(doubled) == {LITERAL}
    assert len(secret_scan.named_spans(chain)) == 3001


@pytest.mark.parametrize("line", [
    "signing_secret: str = {}", "const apiToken: string = {};", "apiToken : string={}", "password: Optional[str] = {}", "password: Dict[str, List[str]] = {}",
    "password: str | None = {}", "password: 'Secret' = {}", "let apiToken: Array<string | null>={}", "const TOKEN: &'static str = {};", "val token: String? = {}",
    "def f(name: str = 'x', token: Annotated[str, Field(min_length=3)] = {}):", "private readonly token: readonly string[] = {}", "password: typing.Final = {}",
    "a: password = {}", "a: password={}", "INFO: password: {}", "password = backup = {}", "a = b = password = {}", "x: y = password = {}", "level: info, note: a[1], token: b[2] = {}",
])
def test_annotated_and_nested_assignments(line):
    assert LITERAL in found(line.format(f'"{LITERAL}"'))


def test_types_are_no_values():
    assert found(f'title: str = "{LITERAL}"\npassword: str\n') == set()
    assert found(f'base: str = "{LITERAL}"\npassword: str = base\n') == {LITERAL}
    assert found(f'title: str | None = "{LITERAL}"\npassword = None\n') == found(f'title: str = "{LITERAL}"\nf(password=str)\n') == set()
    assert found(f'title: Title = "{LITERAL}"\npassword: Title\n') == set()
    assert found(f'note: base = "{LITERAL}"\npassword = base\n') == {LITERAL}
    assert found('signing_secret: str = "hello"\nn: int = 5\n') == set()


def test_bare_values_with_signs_stay_whole():
    assert found("token=aGVsbG8gd29=ybGQ9x7") >= {"aGVsbG8gd29=ybGQ9x7"}
    assert found("secret: aGVsbG8gd29ybGQ9x7==") == {"aGVsbG8gd29ybGQ9x7=="}
    assert "zK8-qW2-mN5x" in found("url: https://host/path?token=zK8-qW2-mN5x")


def test_long_runs_of_assignments_end():
    for text in ("a=b&" * 100_000, "a: [" * 100_000, "a = " * 100_000, "a:b<" * 100_000, "a = b + " * 50_000):
        assert found(f"{text} 'salt'") == set()
    assert found(f"""{"a = " * 50_000}"{LITERAL}"\npassword = a""") == {LITERAL}
