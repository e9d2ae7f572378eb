"""Typed values from source text, as SQL expressions over a column or expression ``text``.

None of these raise: text that breaks the rule gives NULL, and the caller decides whether
that is an error. They are kept small on purpose. The expressions of one projection become
one generated Java method, and a method the JIT refuses to compile runs several times slower.
So text of the usual shape takes a plain cast, and exact arithmetic is a function of its own,
which generated methods only call.
"""

from __future__ import annotations

# The characters that count as white space, texts that stand for "no date",
# the source date pattern and the range a source date may fall in.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NO_DATE = ("", "NaT", "nat", "NAT", "nan", "NaN", "NAN")
SOURCE_DATE = "M/d/yyyy"
FIRST_DATE = "1677-09-22"
LAST_DATE = "2262-04-11"

# Exact types. Ten whole digits and sixteen decimals of a price keep its product with a quantity
# of ten digits exact in 38 digits; numbers may have eighteen decimals.
EXACT, EXACT_DECIMALS = "decimal(38,18)", 18
# Text that is an INT at a glance, a whole number of at most eighteen digits with nothing but zeros
# after the point, and whatever else may be whole: with an exponent, longer, or not in ASCII.
PLAIN_INT = r"^[\x00-\x20]*[+-]?[0-9]{1,9}[\x00-\x20]*$"
PLAIN_WHOLE = r"^[\x00-\x20]*([+-]?[0-9]{1,18})([.]0*)?[\x00-\x20]*$"
MAYBE_WHOLE = r"^[\x00-\x20\x7F]*[+-]?([0-9]+([.]0*)?|[.]0+|[0-9]*[.]?[0-9]*[eE][+-]?[0-9]+)[\x00-\x20\x7F]*$|[^\x00-\x7F]"
MONEY, MONEY_DECIMALS = "decimal(26,16)", 16


def stripped(text: str) -> str:
    """Text without white space at either end, whatever kind of white space it is."""
    return f"trim(BOTH '{WHITE_SPACE}' FROM {text})"


def is_blank(text: str) -> str:
    """True for NULL, empty and white-space-only text."""
    return f"coalesce({stripped(text)} = '', true)"


def _fits(text: str, decimals: int) -> str:
    """Whether number text has no more decimals than that, so that a cast rounds nothing away.

    Zeros at the end of the fraction do not count, and an exponent moves the point.
    """
    fraction = f"rtrim('0', regexp_extract({text}, '[.]([0-9]*)', 1))"
    exponent = f"coalesce(try_cast(regexp_extract({text}, '[eE]([+-]?[0-9]+)', 1) AS int), 0)"
    return f"length({fraction}) - {exponent} <= {decimals}"


def _apart(text: str, value: str) -> str:
    """The value of ``t``, which stands for the text, evaluated outside the generated method."""
    return f"transform(array({text}), t -> {value})[0]"


def whole_number(text: str) -> str:
    """INT from text such as ``01``, `` 2 ``, ``+5``, ``2.0`` or ``1e2``; else NULL.

    A cast that fails costs an exception, and the exact decimal twenty times the plain cast. So
    the shape of the text decides first, and only text of a rare shape pays for either.
    """
    exact = f"try_cast(t AS {EXACT})"
    exactly = f"try_cast(CASE WHEN {exact} % 1 = 0 AND {_fits('t', EXACT_DECIMALS)} THEN {exact} END AS int)"
    digits = f"cast(regexp_extract(t, r'{PLAIN_WHOLE}', 1) AS bigint)"
    rarely = f"""CASE WHEN t RLIKE r'{PLAIN_WHOLE}' THEN CASE WHEN {digits} BETWEEN -2147483648 AND 2147483647 THEN cast({digits} AS int) END
                      WHEN t RLIKE r'{MAYBE_WHOLE}' THEN coalesce(CASE WHEN NOT t RLIKE '[.eE]' THEN try_cast(t AS int) END, {exactly})
                 END"""
    return f"CASE WHEN {text} RLIKE r'{PLAIN_INT}' THEN cast({text} AS int) ELSE {_apart(text, rarely)} END"


def positive_integer(text: str) -> str:
    """Whether text is a whole number above zero that fits 64 bits."""
    exact = f"try_cast(t AS {EXACT})"
    exactly = f"{exact} > 0 AND {exact} % 1 = 0 AND try_cast({exact} AS bigint) IS NOT NULL AND {_fits('t', EXACT_DECIMALS)}"
    return f"coalesce(try_cast({text} AS bigint) > 0, {_apart(text, exactly)}, false)"


def money(text: str) -> str:
    """Exact decimal from price text such as `` $1,200.25 ``; else NULL, also beyond sixteen decimals.

    Text of at most as many characters without an exponent cannot have more decimals.
    """
    bare = stripped(f"replace(replace({text}, '$', ''), ',', '')")
    exactly = _apart(bare, f"CASE WHEN {_fits('t', MONEY_DECIMALS)} THEN try_cast(t AS {MONEY}) END")
    short = f"length({text}) <= {MONEY_DECIMALS} AND instr(lower({text}), 'e') = 0"
    return f"CASE WHEN {short} THEN try_cast({bare} AS {MONEY}) ELSE {exactly} END"


def source_date(text: str) -> str:
    """DATE from month/day/four-digit-year text, zero padding optional; else NULL.

    The formatter alone would also take longer months and days, such as 001/5/2024.
    """
    shaped = f"instr({text}, '/') BETWEEN 2 AND 3 AND length({text}) - instr({text}, '/') <= 7"
    return f"CASE WHEN {shaped} THEN try_to_date({text}, '{SOURCE_DATE}') END"


def zero_padded_day(text: str) -> str:
    """Date text with a space-padded day, as in ``1/ 5/2024``, padded by a zero instead."""
    return f"replace({text}, '/ ', '/0')"


def in_date_range(day: str) -> str:
    return f"{day} BETWEEN DATE'{FIRST_DATE}' AND DATE'{LAST_DATE}'"


def no_date(text: str) -> str:
    """True where text stands for an absent date rather than a wrong one."""
    listed = ", ".join(f"'{word}'" for word in NO_DATE)
    return f"({text} IS NULL OR {text} IN ({listed}))"


def required(value: str, message: str) -> str:
    """The value, or a failed job where it is NULL."""
    return f"coalesce({value}, raise_error('{message}'))"


def or_fail(rules: dict[str, str]) -> str:
    """True where every condition holds; a failed job, with the condition's message, where one does not.

    As a filter, or in a column a filter needs, it stays in the plan whichever columns are read.
    """
    cases = " ".join(f"WHEN NOT coalesce({holds}, false) THEN raise_error('{message}')" for holds, message in rules.items())
    return f"CASE {cases} ELSE true END"
