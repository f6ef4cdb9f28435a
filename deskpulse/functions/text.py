"""Numbers and keys as the published tables spell them."""

from pyspark.sql import functions as F


def _as_column(column):
    return F.col(column) if isinstance(column, str) else column


def hundredths_text(seconds, minus_days=None):
    """Days with two decimals for a whole number of seconds, less some whole days.

    The text rounds the double ``seconds / 86400`` as it is in binary, ties to
    even. One hundredth is 864 seconds, so integers settle all but the remainder
    432, where the stored double lies just above, just below or on the tie. There
    its fraction is scaled by 2**60, which is exact, and compared in decimals.
    Whole days taken off never change the fraction, so they come off last.
    """
    seconds = _as_column(seconds)
    size = F.abs(seconds).cast("bigint")
    down = F.floor(size / 864)
    rest = size % 864

    days = size / F.lit(86400.0)
    whole = F.floor(days)
    scale = 2**60
    stored = ((days - whole) * F.lit(float(scale))).cast("bigint").cast("decimal(20,0)") * F.lit(
        200
    ).cast("decimal(3,0)")
    tie = (down * 2 + 1 - whole * 200).cast("decimal(5,0)") * F.lit(scale).cast("decimal(20,0)")
    at_tie = F.when(stored > tie, 1).when(stored < tie, 0).otherwise(down % 2)
    up = F.when(rest > 432, 1).when(rest < 432, 0).otherwise(at_tie)

    total = down + up
    if minus_days is not None:
        total = total - _as_column(minus_days).cast("bigint") * 100
    sign = F.when(seconds < 0, "-").otherwise("")
    return F.concat(
        sign,
        F.floor(total / 100).cast("string"),
        F.lit("."),
        F.lpad((total % 100).cast("string"), 2, "0"),
    )


def whole_number_text(column):
    """A double without decimals as text: 4.0, 10000000.0; with an exponent from 1e16 on."""
    value = _as_column(column).cast("double")
    return F.when(
        F.abs(value) < 1e16, F.concat(value.cast("bigint").cast("string"), F.lit(".0"))
    ).otherwise(value.cast("string"))


# Where each style lays a number out without an exponent: powers of ten of its first digit.
STYLES = {"python": (-4, 15), "spark": (-3, 6), "plain": (-400, 400)}


def _spelled(value, plain, digits, power, style):
    """Text of a double from its significant digits and the power of ten of the first."""
    least, most = STYLES[style]
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(
        F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0")),
        F.lit("."),
        F.when(F.length(digits) > power + 1, F.substring(digits, power + 2, F.lit(20))).otherwise("0"),
    )
    rest = F.substring(digits, 2, 20)
    if style == "spark":
        exponent = F.concat(F.lit("E"), power.cast("string"))
        rest = F.concat(F.lit("."), F.when(F.length(digits) > 1, rest).otherwise("0"))
        scientific = F.concat(F.substring(digits, 1, 1), rest, exponent)
    else:
        scientific = F.concat(
            F.substring(digits, 1, 1),
            F.when(F.length(digits) > 1, F.concat(F.lit("."), rest)).otherwise(""),
            F.when(power < 0, "e-").otherwise("e+"),
            F.when(F.abs(power) < 10, "0").otherwise(""),
            F.abs(power).cast("string"),
        )
    laid_out = (
        F.when((power >= least) & (power < 0), small)
        .when((power >= 0) & (power <= most), large)
        .otherwise(scientific)
    )
    if style == "python":
        nan, infinite = F.lit("nan"), F.when(value > 0, "inf").otherwise("-inf")
    else:
        nan = infinite = plain
    return (
        F.when(F.isnan(value), nan)
        .when(F.abs(value) == float("inf"), infinite)
        .when(value == 0, plain)
        .otherwise(F.concat(F.when(value < 0, "-").otherwise(""), laid_out))
    )


# Doubles of this range are whole numbers which two bigints hold exactly.
EXACT_FROM, EXACT_TO = float(2**53), 1e27
SMALLEST_NORMAL = 2.0**-1022


def _exact_whole(size):
    """All digits of a double between EXACT_FROM and EXACT_TO."""
    upper = F.floor(size / EXACT_FROM)
    lower = (size - upper * F.lit(EXACT_FROM)).cast("bigint").cast("decimal(19,0)")
    return upper.cast("decimal(19,0)") * F.lit(2**53).cast("decimal(17,0)") + lower


def _let(value, body):
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shortest(given):
    """Digits and power of the first one of the shortest number that reads back, or null.

    With ``sure`` digits only the nearest number can read back. With one more the two
    neighbours are tried, the nearer one first, then the even one. One more always does.
    """
    digits, first, sure, size = (given[p] for p in ("digits", "first", "sure", "size"))

    def cut(n):
        low = F.substring(digits, F.lit(1), n).try_cast("bigint")
        return F.struct(low.alias("low"), F.substring(digits, n + 1, F.lit(40)).alias("rest"))

    def up(parts):
        return (parts["rest"] > "5") | ((parts["rest"] == "5") & (parts["low"] % 2 == 1))

    def if_read_back(number, n):
        def checked(text):
            same = F.concat(text, F.lit("E"), (first - n + 1).cast("string")).try_cast("double") == size
            return F.when(same, F.struct(text.alias("text"), (first - n + F.length(text)).alias("first")))

        return _let(number.cast("string"), checked)

    def nearest(n):
        return _let(cut(n), lambda parts: if_read_back(parts["low"] + up(parts).cast("int"), n))

    def either(n):
        def tried(parts):
            return F.coalesce(
                if_read_back(parts["low"] + up(parts).cast("int"), n),
                if_read_back(parts["low"] + (~up(parts)).cast("int"), n),
            )

        return _let(cut(n), tried)

    whole = F.when(F.length(digits) <= sure + 1, F.struct(digits.alias("text"), first.alias("first")))
    return F.coalesce(nearest(sure), whole, either(sure + 1), nearest(sure + 2))


def with_float_texts(df, *names, style="python"):
    """Turn double columns into the shortest texts that read back to them.

    4.0, 1e-05 or 12345678.0, as Python writes them; style ``spark`` lays them out as a
    cast does (1.0E-5, 1.2345678E7), ``plain`` never uses an exponent. Each step is a
    projection of its own, so every part is computed once per row.

    A cast gives digits that read back, but not always the fewest: that depends on the
    Java version. No two numbers of up to 15 digits read back as one double, so longer
    digits are rounded to 15, and where that does not read back, to 16 and 17. Large whole
    numbers start from all their digits, the smallest doubles need fewer than 15.
    """

    def step(df, **parts):
        return df.withColumns({f"_{n}_{part}": f(n) for n in names for part, f in parts.items()})

    def part(name, of):
        return F.col(f"_{of}_{name}")

    def is_exact(n):
        return (part("size", n) >= EXACT_FROM) & (part("size", n) < EXACT_TO)

    def mantissa(n):
        return F.when(part("plain", n).contains("E"), F.substring_index(part("plain", n), "E", 1)).otherwise(part("plain", n))

    def all_digits(n):
        return F.when(is_exact(n), _exact_whole(part("size", n)).cast("string")).otherwise(
            F.translate(mantissa(n), ".-", "")
        )

    def exponent(n):
        plain = part("plain", n)
        return F.when(plain.contains("E"), F.substring_index(plain, "E", -1).try_cast("int")).otherwise(0)

    def first_power(n):
        """Power of ten of the first digit."""
        whole = F.length(part("all", n)) - 1
        return F.when(is_exact(n), whole).otherwise(
            exponent(n)
            + F.instr(part("plain", n), ".")
            - F.when(F.col(n) < 0, 3).otherwise(2)
            - (F.length(part("all", n)) - F.length(F.ltrim(part("all", n), F.lit("0"))))
        )

    def cut(n, length):
        return _cut(part("digits", n), part("first", n), length, part("size", n))

    def sure(n):
        """So many digits tell all doubles of this size from each other."""
        return F.when(part("size", n) < SMALLEST_NORMAL, part("first", n) + 324).otherwise(15)

    def found(n):
        """Looked for in a lambda, which keeps the rare search out of the generated code."""
        given = F.struct(*[part(p, n).alias(p) for p in ("digits", "first", "sure", "size")])
        long = F.length(part("digits", n)) > part("sure", n)
        return F.when(long, F.element_at(F.transform(F.array(given), _shortest), 1))

    df = df.withColumns({n: F.col(n).cast("double") for n in names})
    df = step(df, plain=lambda n: F.col(n).cast("string"), size=lambda n: F.abs(F.col(n)))
    df = step(df, all=all_digits)
    df = step(
        df,
        digits=lambda n: F.ltrim(F.rtrim(part("all", n), F.lit("0")), F.lit("0")),
        first=first_power,
    )
    df = step(df, sure=sure)
    df = step(df, found=found)
    df = step(
        df,
        text=lambda n: F.coalesce(F.rtrim(part("found", n)["text"], F.lit("0")), part("digits", n)),
        place=lambda n: F.coalesce(part("found", n)["first"], part("first", n)),
    )
    texts = {
        n: _spelled(F.col(n), part("plain", n), part("text", n), part("place", n), style)
        for n in names
    }
    kept = [c for c in df.columns if not any(c.startswith(f"_{n}_") for n in names)]
    return df.select(*[texts[c].alias(c) if c in texts else F.col(c) for c in kept])


def nan_text_as_zero(column):
    """Text 'nan' read as '0.0'."""
    text = _as_column(column)
    return F.when(text == "nan", "0.0").otherwise(text)


def with_comma_texts(df, *names, plain=False):
    """Turn double columns into texts with a decimal comma.

    ``plain`` spells large and small numbers out instead of with an exponent; no digit
    is lost either way.
    """
    spelled = with_float_texts(df, *names, style="plain" if plain else "spark")
    return spelled.withColumns({n: F.translate(F.col(n), ".", ",") for n in names})


def lowered(column):
    return F.lower(_as_column(column))


def request_key(project, flow, request):
    """project_flow_request in lower case; null when any part is null."""
    return F.lower(
        F.concat(_as_column(project), F.lit("_"), _as_column(flow), F.lit("_"), _as_column(request))
    )
