"""Text functions as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ustrip(c: Column) -> Column:
    """Unicode-aware strip, as H1 of the survey asks for."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_line(c: Column) -> Column:
    """Soft hyphens out; runs of space, tab and ideographic space as one space; stripped."""
    return ustrip(F.regexp_replace(F.replace(c, F.lit("­"), F.lit("")), r"[ \t　]+", " "))


def norm_layout(c: Column) -> Column:
    """Tabs as four spaces, right-stripped."""
    return F.regexp_replace(F.replace(c, F.lit("\t"), F.lit("    ")), r"(?U)\s+$", "")


def norm_integrity(c: Column) -> Column:
    """What may change without a loss of content taken out: pipes, leading #, backticks, ::: markers, white space."""
    c = F.regexp_replace(c, r"(?m)^[|\s:-]+$", "")
    c = F.regexp_replace(c, r"(?m)^:::.*$|^#+|[|`]", "")
    return F.regexp_replace(c, r"(?U)\s+", "")


def full_to_half(c: Column) -> Column:
    return F.translate(c, "ＡＢＣＤ", "ABCD")


def hyphens(c: Column) -> Column:
    return F.translate(c, "‑–", "--")


def context(c: Column, at: Column, size: int = 30) -> Column:
    """The characters within size of position `at` (from 1)."""
    return F.substring(c, F.greatest(at - size, F.lit(1)), F.lit(2 * size))


def display_width(c: Column) -> Column:
    """Columns on a terminal: wide and full-width characters count two."""
    wide = r"[ᄀ-ᅟ⺀-〾ぁ-㏿㐀-䶿一-鿿ꀀ-꓏가-힣豈-﫿︰-﹯＀-｠￠-￦]"
    return F.length(c) + F.regexp_count(c, F.lit(wide))


def cjk_spacing(c: Column) -> Column:
    """A hair space between CJK and Latin or digits, outside tags."""

    def spaced(p: Column) -> Column:
        p = F.regexp_replace(p, r"(?<=[一-鿿])(?=[A-Za-z0-9])", "\u200a")
        return F.regexp_replace(p, r"(?<=[A-Za-z0-9])(?=[一-鿿])", "\u200a")

    parts = F.regexp_extract_all(c, F.lit("<[^>]*>|[^<]+|<"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^<.*>$"), p).otherwise(spaced(p))), "")


def join_lines(a: Column, b: Column) -> Column:
    """Two lines as one, with a space only between letters or digits of ASCII."""
    return F.when(a.rlike(r"[A-Za-z0-9]$") & b.rlike(r"^[A-Za-z0-9]"), F.concat(a, F.lit(" "), b)).otherwise(F.concat(a, b))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w一-鿿]+", "_"), "^_+|_+$", "")


def strip_tags(c: Column) -> Column:
    """Tags out and the five basic references decoded, & last."""
    c = F.regexp_replace(c, r"<[^>]+>", "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def mask_pii(c: Column) -> Column:
    """Mail addresses and runs of four or more digits replaced by a tag."""
    c = F.regexp_replace(c, EMAIL, "<email>")
    return F.regexp_replace(c, "[0-9]{4,}", "<number>")


#: A fixed pattern of mail addresses, in what Java and RE2 share.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def escape_cell(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def truncate(c: Column, n: int = 110) -> Column:
    return F.substring(F.regexp_replace(c, r"(?U)\s+", " "), 1, n)


def shingles(words: Column, k: int) -> Column:
    """Runs of k words of an array, joined by spaces; none if it is shorter."""
    cut = lambda w: F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))).otherwise(F.array().cast("array<string>"))
    # words are bound once; inside the inner function they would be worked out again for each run
    return F.transform(F.array(words), cut)[0]


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def availability_downtime(pct: Column, minutes: float = 525_600.0) -> Column:
    """Minutes of downtime a year at an availability in percent."""
    return (100 - pct) / 100 * minutes


def credit_score(odds: Column, base: float, pdo: float) -> Column:
    return F.lit(base) - F.lit(pdo) / F.log(F.lit(2.0)) * F.log(odds)


def npv(flows: Column, rate: float) -> Column:
    """Net present value of an array of cash flows, the first at time 0."""
    return F.aggregate(F.transform(flows, lambda v, t: v / F.pow(F.lit(1 + rate), t)), F.lit(0.0), lambda s, v: s + v)


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of boxes (x1, y1, x2, y2)."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    return w * h / (area(a) + area(b) - w * h)


def box_cox(c: Column, power: float) -> Column:
    """The Box-Cox transform of positive values at a given power; null elsewhere."""
    return F.when(c > 0, F.log(c) if power == 0 else (F.pow(c, F.lit(power)) - 1) / power)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; null where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def first_difference(a: Column, b: Column) -> Column:
    """Where two texts part (from 0): the first place of different characters, or the shorter one's end; null if equal.

    Characters are split once, so the work is in proportion to the texts."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    return F.when(a != b, F.array_position(same, False).cast("int") - 1)


def han_together(c: Column) -> Column:
    """Spaces between Han characters taken out."""
    return F.regexp_replace(c, r"(?<=[一-鿿]) (?=[一-鿿])", "")


def tidy_punctuation(c: Column) -> Column:
    """Spaces before punctuation and at the end taken out."""
    return F.rtrim(F.regexp_replace(c, r" +([,.;:!?])", "$1"))


def inline_markdown(c: Column) -> Column:
    """Inline Markdown as HTML: text escaped, strong and em outside code spans, which are taken as they are.

    A line is parted at its code spans, so that no rule reaches into one."""
    for x, y in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(x), F.lit(y))
    parts = F.split(c, "`", -1)
    plain = lambda p: F.regexp_replace(F.regexp_replace(p, r"\*\*(.+?)\*\*", "<strong>$1</strong>"), r"\*(.+?)\*", "<em>$1</em>")
    code = lambda p: F.concat(F.lit("<code>"), p, F.lit("</code>"))
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, plain(p)).otherwise(code(p))), "")
