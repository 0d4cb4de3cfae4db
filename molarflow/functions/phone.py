"""Phone canonicalisation (STR4) and search variants (STR5).

`phone_key` turns every spelling of one Brazilian number (with or without the
country code 55, with or without the mobile 9) into one string, so the
lead-to-appointment match is a single equi-join key instead of an OR of
variants (which Spark could only run as a nested loop).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from molarflow.functions.text import phone_digits


def phone_key(c: Column | str) -> Column:
    """STR4: digits; 12/13 digits starting with 55 lose the 55; then 11 digits
    whose third digit is 9 lose that 9. Null or without a digit: null. Short keys
    stay; the funnel has one row per key on its right side, so none can fan out.

    Written as a chain of single-reference regex steps so the generated code
    stays small (a CASE tree re-evaluating the digits at every branch grows
    exponentially and falls out of whole-stage codegen)."""
    d = phone_digits(c)
    no_cc = F.regexp_replace(d, r"^55(?=[0-9]{10,11}$)", "")
    no_nine = F.regexp_replace(no_cc, r"^([0-9]{2})9([0-9]{8})$", "$1$2")
    # regexp_substr yields NULL when nothing matches: one evaluation, no nullif re-check
    return F.regexp_substr(no_nine, F.lit(r"^[0-9]+$"))


def phone_variants(digits: str) -> list[str]:
    """STR5 on the driver: search variants of a digit string (at most 3)."""
    out: list[str] = []

    def add(v: str) -> None:
        if v not in out:
            out.append(v)

    if len(digits) < 4:
        return out
    add(digits)
    n = len(digits)
    if n == 10:
        add(digits[:2] + "9" + digits[2:])
    if n == 11 and digits[2] == "9":
        add(digits[:2] + digits[3:])
    if n == 13 and digits.startswith("55") and digits[4] == "9":
        add(digits[2:])
        add(digits[2:4] + digits[5:])
    if n == 12 and digits.startswith("55"):
        add(digits[2:])
        add(digits[2:4] + "9" + digits[4:])
    return out
