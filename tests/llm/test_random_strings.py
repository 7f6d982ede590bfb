"""Random strings of each alphabet are secrets; words, names and numbers aren't."""

import base64
import random
import string

import public_tokenizers
import pytest

from connlens.llm import secrets

HEX = "0123456789"
PLAIN = [
    "keitzuchheitheitkeitlichung", "INTERNATIONALIZATION_SETTINGS", "getElementsByClassNameAndTagName", "a_long_identifier_with_words_2024",
    "123e4567-e89b-12d3-a456-426614174000", "1234-5678-9012-3456-7890", "-" * 40, "=" * 40,
]


@pytest.fixture(scope="module")
def scanner():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.read().splitlines())}
    return secrets.Scanner(ranks, public_tokenizers.PATTERN, secrets.Efficiency())


@pytest.mark.parametrize("length", [24, 32, 40, 64])
@pytest.mark.parametrize(
    "alphabet",
    [string.ascii_lowercase, string.ascii_uppercase, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, HEX + "ABCDEF", string.ascii_letters + string.digits + "+/"],
)
def test_random_strings(scanner, alphabet, length):
    rng = random.Random(length)
    runs = ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(500)]
    assert sum(any(s <= 4 and e >= 4 + length for s, _, e in scanner.spans(f"key {r} end")) for r in runs) >= 490


@pytest.mark.parametrize("run", PLAIN)
def test_plain_runs(scanner, run):
    assert scanner.spans(f"see {run} here") == []


def test_known_digests(scanner):
    digest = "9F86D081884C7D659A2FEAA0C55AD015"
    assert scanner.spans(digest) == [(0, 3, 32)]
    known = secrets.Scanner.__new__(secrets.Scanner)
    known.encoding, known.how = scanner.encoding, secrets.Efficiency(known=frozenset([digest]))
    assert known.spans(digest) == []
