"""Base58 as native columns, in words of a few digits and limbs of 32 bits, so that every product and carry fits a long.
Reading takes digits as base64 ones, whose bits stand side by side, four to a word, and weighs nine words by the
powers of 58**4. Writing takes five digits (58**5 < 2**30) at a time out of seven limbs: 7 x 7 steps for an address.

Everything returns null where the input is malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import let

ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
LIMBS, TAKEN = 7, 5
CHARS = LIMBS * TAKEN
STEP, LIMB = 58**TAKEN, 1 << 32
#: Reading: characters of the same number in base64, digits of a word, words, and the powers of 58**4, highest first, in limbs, lowest first.
SIXTY_FOUR = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz012345"
READ, WORDS = 4, 9
WEIGHTS = [[58 ** (READ * k) >> 32 * j & LIMB - 1 for j in range(LIMBS)] for k in reversed(range(WORDS))]


def _reading() -> str:
    """Digits p to 56 hex digits. As SQL text, since its thousand columns would be a second of calls for each use."""
    field = lambda i, n: f"(shiftright(v[{i}], {6 * (READ - 1 - n)}) & 63L) * {58 ** (READ - 1 - n)}L"
    word = lambda i: " + ".join(field(i, n) for n in range(READ))
    total = lambda j: " + ".join(["0L", *[f"w[{i}] * {x[j]}L" for i, x in enumerate(WEIGHTS) if x[j]]])
    carried = lambda j: f"t[{j}]" if j == 0 else f"(t[{j}] + shiftright({carried(j - 1)}, 32))"
    sixes = f"transform(array(hex(unbase64(translate(p, '{ALPHABET}', '{SIXTY_FOUR}')))), h -> array({', '.join(f'bigint(conv(substr(h, {6 * i + 1}, 6), 16, 10))' for i in range(WORDS))}))[0]"
    words = f"transform(array({sixes}), v -> array({', '.join(map(word, range(WORDS)))}))[0]"
    totals = f"transform(array({words}), w -> array({', '.join(map(total, range(LIMBS)))}))[0]"
    out = ", ".join(f"lpad(hex({carried(j)} & {LIMB - 1}L), 8, '0')" for j in reversed(range(LIMBS)))
    return f"p -> transform(array({totals}), t -> lower(concat({out})))[0]"


READING = _reading()


def decode(text: Column) -> Column:
    """The bytes of a base58 string of up to 35 characters, as lower-case hex."""
    number = F.get(F.call_function("transform", F.array(F.lpad(text, READ * WORDS, "1")), F.expr(READING)), F.lit(0))
    zeros = F.char_length(F.regexp_extract(text, "^(1*)", 1))
    # 58**35 is below 2**206 and the sums of a limb are below 2**60, so nothing overflows
    return F.when(text.rlike(rf"^[{ALPHABET}]{{1,{CHARS}}}\z"), F.concat(F.repeat(F.lit("00"), zeros), F.regexp_replace(number, "^(?:00)+", "")))


def encode(hexed: Column) -> Column:
    """Base58 string of up to 28 bytes given as hex."""
    padded = F.lpad(hexed, LIMBS * 8, "0")  # twice the digits of 28 bytes
    limbs = F.transform(F.sequence(F.lit(0), F.lit(LIMBS - 1)), lambda i: F.conv(F.substring(padded, i * 8 + 1, F.lit(8)), 16, 10).cast("long"))

    def divide(acc: Column, _: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("rest"), F.array().cast("array<bigint>").alias("out"))

        def step(a: Column, limb: Column) -> Column:
            total = a["rest"] * LIMB + limb
            return F.struct((total % STEP).alias("rest"), F.array_append(a["out"], F.call_function("div", total, F.lit(STEP))).alias("out"))

        done = F.aggregate(acc["limbs"], start, step)
        return F.struct(done["out"].alias("limbs"), F.concat(_digits(done["rest"]), acc["text"]).alias("text"))

    first = F.struct(limbs.alias("limbs"), F.lit("").alias("text"))
    text = F.aggregate(F.sequence(F.lit(1), F.lit(LIMBS + 1)), first, divide, lambda acc: acc["text"])
    zeros = F.char_length(F.regexp_extract(hexed, "^((?:00)*)", 1)) / 2
    return F.when(hexed.rlike(r"^(?:[0-9a-fA-F]{2}){1,28}\z"), F.concat(F.repeat(F.lit("1"), zeros.cast("int")), F.regexp_replace(text, "^1+", "")))


def _digits(value: Column) -> Column:
    """Five base58 digits of a number below 58**5."""
    parts, rest = [], value
    for _ in range(TAKEN):
        parts.append(F.substring(F.lit(ALPHABET), (rest % 58 + 1).cast("int"), F.lit(1)))
        rest = F.floor(rest / 58)
    return F.concat(*reversed(parts))


def checksum(payload: Column) -> Column:
    """First four bytes of the double sha256 of hex bytes."""
    return F.substring(F.sha2(F.unhex(F.sha2(F.unhex(payload), 256)), 256), 1, 8)


def checked_payload(text: Column) -> Column:
    """Version byte and 20-byte payload (42 hex digits) of a base58check string whose checksum holds."""

    def check(raw: Column) -> Column:
        payload = F.substring(raw, 1, 42)
        return F.when((F.char_length(raw) == 50) & (F.substring(raw, 43, 8) == checksum(payload)), payload)

    return F.when(text.rlike(rf"^[{ALPHABET}]{{25,35}}\z"), let(decode(text), check))


def tron_to_hex(text: Column) -> Column:
    """0x-hex form of a checksum-valid Tron mainnet address."""
    return F.when(F.char_length(text) == 34, let(checked_payload(text), lambda p: F.when(F.startswith(p, F.lit("41")), F.concat(F.lit("0x"), F.substring(p, 3, 40)))))


def hex_to_tron(text: Column) -> Column:
    """T form of 0x and 40 hex digits."""
    payload = F.concat(F.lit("41"), F.lower(F.substring(text, 3, 40)))
    return F.when(text.rlike(r"^0x[0-9a-fA-F]{40}\z"), let(payload, lambda p: encode(F.concat(p, checksum(p)))))


def is_tron(text: Column) -> Column:
    return F.coalesce(F.startswith(text, F.lit("T")) & tron_to_hex(text).isNotNull(), F.lit(False))


def _has_version(text: Column, versions: tuple[str, ...]) -> Column:
    return F.coalesce(F.substring(checked_payload(text), 1, 2).isin(*versions), F.lit(False))


def is_bitcoin_legacy(text: Column) -> Column:
    """P2PKH or P2SH on mainnet."""
    return F.coalesce(text.rlike(r"^[13].{25,34}\z"), F.lit(False)) & _has_version(text, ("00", "05"))


def is_litecoin_legacy(text: Column) -> Column:
    return _has_version(text, ("30", "32", "05"))
