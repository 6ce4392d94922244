"""Text expressions: claims, canonical forms, page shells and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIALIZER_VERSION = "1"
# fixed values: what makes a page a shell of scripts
SHELL_VISIBLE_BYTES, SHELL_SCRIPT_SHARE = 200, 0.4


# fixed values: white space of any kind
WHITE_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def claim(line: Column) -> Column:
    """What stands before the first colon, or the whole line."""
    return F.when(F.instr(line, ":") > 0, stripped(F.substring_index(line, ":", 1))).otherwise(line)


def value(line: Column) -> Column:
    """What stands after the first colon, later colons included, or the whole line."""
    return F.when(F.instr(line, ":") > 0, stripped(F.substr(line, F.instr(line, ":") + 1))).otherwise(line)


def canonical(evidence_type: Column, role: Column, section: Column, context: Column) -> Column:
    """The deterministic text of an evidence row; an unknown type is an error."""
    body = F.when(evidence_type == "table", F.concat(F.lit("Table — "), context)).otherwise(context)
    headed = F.when(F.coalesce(section, F.lit("")) == "", body).otherwise(F.concat(section, F.lit(": "), body))
    known = F.when((evidence_type == "text") & (role == "heading"), context).when(evidence_type.isin("text", "table", "visual"), headed)
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown evidence type: "), F.coalesce(evidence_type, F.lit("null")))))


def is_shell(html: Column, content_type: Column) -> Column:
    """A page of scripts with hardly any text, which only a browser can read."""
    bare = F.regexp_replace(html, r"(?i)<script[\s\S]*?</script>", "")
    scripts = F.octet_length(html) - F.octet_length(bare)
    visible = F.regexp_replace(F.regexp_replace(bare, r"<[^>]+>", ""), r"^\s+|\s+$", "")
    shell = (F.octet_length(visible) < SHELL_VISIBLE_BYTES) & (scripts > SHELL_SCRIPT_SHARE * F.octet_length(html))
    return F.coalesce(F.coalesce(content_type, F.lit("")).contains("html") & (F.octet_length(html) > 0) & shell, F.lit(False))


def shortened(text: Column, most: int = 160) -> Column:
    """On one line, of at most ``most`` characters, the last an ellipsis where something is cut off."""
    flat = stripped(F.replace(text, F.lit("\n"), F.lit(" ")))
    return F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - 1), F.lit("…"))).otherwise(flat)


def byte_text(size: Column) -> Column:
    """1536 as "1.5 KB"; whole numbers without a decimal."""
    out = F.when(F.coalesce(size, F.lit(0)) == 0, "0 B")
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        scaled = F.round(size / 1024**power, 1)
        shown = F.regexp_replace(F.format_string("%.1f", scaled), r"\.0$", "")
        out = out.when(size >= 1024**power, F.concat(shown, F.lit(f" {unit}")))
    return out


def duration_text(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.format_string("%dm %ds", F.floor(whole / 60), whole % 60)


def html_escaped(text: Column) -> Column:
    out = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def json_in_html(json_text: Column) -> Column:
    """JSON that can stand in a script element."""
    return F.replace(json_text, F.lit("</"), F.lit("<\\/"))


def sha256_text(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "utf-8"), 256)


def iso_text(stamp: Column) -> Column:
    """ISO 8601 with offset; a fraction only if there is one."""
    fraction = F.date_format(stamp, ".SSSSSS")
    return F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == ".000000", "").otherwise(fraction), F.date_format(stamp, "xxx"))


def per_unit(total: Column, units: Column) -> Column:
    """Time per text or query; null without any."""
    return F.try_divide(total, units)
