"""Addresses of locking scripts."""

import base64
import hashlib
import random

import pytest

from ledgerloom.functions.encoding import base58check, hash160, is_curve_point, key_address, ripemd160_portable
from ledgerloom.functions.scripts import decode_address, decode_op_n, script_template, unknown_address, with_address

KEY_A = "03" + "0e7061b9fb18571cf2441b2a7ee2419933ddaa423bc178672cd11e87911616d1"
BAD_KEY = "00f2b7816db49d55d24df7bdffdbc1e203b424e8cd39f5651ab938e5e4a193569e"
LONG_KEYS = (
    "4104cc71eb30d653c0c3163990c47b976f3fb3f37cccdcbedb169a1dfef58bbfbfaff7d8a473e7e2e6d317b87bafe8bde97e3cf8f065dec022b51d11fcdd0d348ac4",
    "410461cbdcc5409fb4b4d42b51d33381354d80e550078cb532a34bfa2fcfdeb7d76519aecc62770f5b0e4ef8551946d8a540911abe3e7854a26f39f58b25c15342af",
)
INVALID = "40f816b480f87144ec4de5862adf028ff66cc6964250325d53fd22bf8922824b6f1e1f2c881ae0608ec77ebf88a75c66d3099113a7343238f2f7a0ebb91a4ed335ac"
HASH = "8a31af61d6384177c4997c728948d5e690ff1534"


def b64(script):
    return base64.b64encode(bytes.fromhex(script)).decode()


# script, address, kind
VECTORS = [
    (f"76a914{HASH}88ac", "1DbhmesUsNZ1hgX7KQtASNU9YRoqk8SiFZ", "P2PKH"),
    (f"21{KEY_A}ac", "1CjRf1RMrTwyGoBHDbqzXERhVFkPyowt8i", "P2PK"),
    ("a9146a00bbd84a3256df3df66cc2c69123c74f8a598e87", "3BMWRrtUmsPaknqVj9jiihYxiPMWcEY8ae", "P2SH"),
    ("0014e8df018c7e326cc253faac7e46cdc51e68542c42", "bc1qar0srrr7xfkvy5l643lydnw9re59gtzzwf5mdq", "P2WPKH"),
    (
        "0020c7a1f1a4d6b4c1802a59631966a18359de779e8a6a65973735a3ccdfdabc407d",
        "bc1qc7slrfxkknqcq2jevvvkdgvrt8080852dfjewde450xdlk4ugp7szw5tk9",
        "P2WSH",
    ),
    (INVALID, "unknown:invalidpubkey:" + b64(INVALID), "UNKNOWN"),
    (
        f"51{LONG_KEYS[0]}{LONG_KEYS[1]}52ae",
        "multisig:1:2:1AJbsFZ64EpEfS5UAjAfcUG8pH8Jn3rn1F:1A8JiWcwvpY7tAopUkSnGuEYHmzGYfZPiq",
        "MULTISIG",
    ),
    (
        f"51210351efb6e91a31221652105d032a2508275f374cea63939ad72f1b1e02f477da7821{BAD_KEY}52ae",
        "1NdB761LmTmrJixxp93nz7pEiCx5cKPW44",
        "MULTISIG",
    ),
    (f"76a914{HASH}88" + "ac" * 900, "unknown:" + b64(f"76a914{HASH}88" + "ac" * 900), "UNKNOWN"),
    ("6a0568656c6c6f", "", "NULL"),
    ("6a4c", "", "NULL"),
    ("76a9148a31", "", "NULL"),  # push past the end
    ("4d01", "", "NULL"),
    (f"76a94c14{HASH}88ac", "1DbhmesUsNZ1hgX7KQtASNU9YRoqk8SiFZ", "P2PKH"),
    (f"a94c14{HASH}87", "unknown:" + b64(f"a94c14{HASH}87"), "UNKNOWN"),
    (f"51{LONG_KEYS[0]}51af", "unknown:" + b64(f"51{LONG_KEYS[0]}51af"), "UNKNOWN"),
    (f"5121{KEY_A}52ae", "unknown:" + b64(f"5121{KEY_A}52ae"), "UNKNOWN"),  # two declared, one given
    (f"5221{KEY_A}51ae", "multisig:2:1:1CjRf1RMrTwyGoBHDbqzXERhVFkPyowt8i", "MULTISIG"),
    (f"510021{KEY_A}52ae", "1CjRf1RMrTwyGoBHDbqzXERhVFkPyowt8i", "MULTISIG"),  # empty push counts as a key
    ("", "unknown:", "UNKNOWN"),
]


@pytest.mark.parametrize("script, address, kind", VECTORS)
def test_decode_address(script, address, kind):
    assert decode_address(bytes.fromhex(script)) == (address, kind)


def test_addresses_in_spark_with_nulls_and_repeats(spark):
    rows = [(i, bytes.fromhex(s)) for i, (s, _, _) in enumerate(VECTORS)] * 3 + [(-1, None)]
    got = with_address(spark.createDataFrame(rows, "i int, script binary")).select("i", "address", "kind").collect()
    assert {tuple(r) for r in got} == {(i, a, k) for i, (_, a, k) in enumerate(VECTORS)} | {(-1, "", "NULL")}
    assert len(got) == len(rows)


def test_native_template_agrees_where_it_decides(spark):
    rows = [(s, bytes.fromhex(s)) for s, _, _ in VECTORS]
    got = {r.s: r.kind for r in spark.createDataFrame(rows, "s string, script binary").select("s", script_template("script").alias("kind")).collect()}
    undecided = {INVALID, "76a9148a31", "4d01", f"510021{KEY_A}52ae"}
    assert {s: got[s] for s, _, _ in VECTORS if s not in undecided} == {s: k for s, _, k in VECTORS if s not in undecided}


def test_unknown_address_is_one_line(spark):
    script = bytes(range(200))
    row = spark.createDataFrame([(script,)], "script binary").select(unknown_address("script")).first()
    assert row[0] == "unknown:" + base64.b64encode(script).decode()


def test_decode_op_n(spark):
    got = spark.range(256).select("id", decode_op_n("id").alias("n")).where("n is not null").collect()
    assert {r.id: r.n for r in got} == {0: 0, 79: -1, **{80 + i: i for i in range(1, 17)}}


def test_portable_ripemd160():
    assert ripemd160_portable(b"abc").hex() == "8eb208f7e05d987a9b044a8e98c6b087f15a0bfc"
    assert ripemd160_portable(b"").hex() == "9c1185a5c5e9fc54612808977ee8f548b2258d31"
    rng = random.Random(1)
    for size in (1, 55, 56, 63, 64, 65, 300):
        data = rng.randbytes(size)
        assert hash160(data) == ripemd160_portable(hashlib.sha256(data).digest())


def test_curve_points():
    x = bytes.fromhex(KEY_A[2:])
    prime = 2**256 - 2**32 - 977
    y = pow(pow(int.from_bytes(x, "big"), 3, prime) + 7, (prime + 1) // 4, prime)
    y = y if y % 2 else prime - y
    plain = b"\4" + x + y.to_bytes(32, "big")
    assert is_curve_point(bytes.fromhex(KEY_A)) and is_curve_point(plain)
    assert is_curve_point(b"\7" + plain[1:]) and not is_curve_point(b"\6" + plain[1:])
    assert key_address(b"\7" + plain[1:]) == key_address(plain)
    assert not is_curve_point(plain[:-1] + bytes([plain[-1] ^ 1]))
    assert not is_curve_point(b"") and not is_curve_point(b"\2" + prime.to_bytes(32, "big"))


def test_base58_keeps_leading_zeros():
    assert base58check(0, bytes(20)) == "1111111111111111111114oLvT2"
