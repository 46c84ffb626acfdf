"""Rule tables. They are data: every operator takes its own as a parameter and these as defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Verdicts, strictest first, and the verdict of rows without evidence.
CLOSED, DISPUTED, PUBLIC, UNKNOWN = "непублично", "спорно", "публично", "не определён"
VERDICTS = [CLOSED, DISPUTED, PUBLIC]


@dataclass(frozen=True)
class RightsClass:
    id: str
    verdict: str
    markers: tuple[str, ...]


# Rights classes and their markers, in rule order.
RIGHTS = (
    RightsClass("патент-ведомства", PUBLIC, ("United States Patent", "UNITED STATES PATENT", "Patent Number:", "Patent Application Publication", "US Patent", "Европейский патент", "Espacenet", "USPTO", "USPTO PDF Builder", "United States Patent and Trademark", "(12) United States Patent", "(19) United States", "Патент США")),
    RightsClass("официальный-документ-РФ", PUBLIC, ("ГОСТ ", "ГОСУДАРСТВЕННЫЙ СТАНДАРТ", "Государственный стандарт", "МЕЖГОСУДАРСТВЕННЫЙ СТАНДАРТ", "ГОСТ", "ГОСТ Р ", "ОСТ ")),
    RightsClass("препринт-arXiv", DISPUTED, ("arXiv:", "arxiv.org/abs")),
    RightsClass("издательская-статья", CLOSED, ("Elsevier", "Springer", "IEEE", "IOP Publishing", "AIP Publishing", "Wiley", "Taylor & Francis", "doi.org/10.", "DOI:", "Metrologia", "IEEE Transactions", "Rev. Sci. Instrum", "All rights reserved.  No part")),
    RightsClass("руководство-изготовителя", CLOSED, ("Hewlett-Packard", "HEWLETT-PACKARD", "Tektronix", "Copyright © Tektronix", "RME", "Avid Technology", "Digidesign", "Steinberg", "Genelec", "MOTU", "Mackie", "TC Electronic", "Dynaudio", "Cockos", "Tracktion", "InstruStar", "Hantek")),
    RightsClass("стандарт-организации", DISPUTED, ("ITU-R", "Recommendation  ITU-R", "EBU TECH", "European Broadcasting Union", "Audio Engineering Society", "ISA-18.2", "International Telecommunication Union")),
)

#: Classes for prose in Latin script, with markers that occur in web text.
LICENCE = (
    RightsClass("open-licence", PUBLIC, ("Creative Commons", "MIT License", "Apache License", "public domain")),
    RightsClass("licence-line", DISPUTED, ("License", "license", "Licence")),
    RightsClass("reserved", CLOSED, ("All rights reserved", "©", "Copyright")),
)

# Forbidden paths; the first that matches counts.
PATHS = (
    ("chat transcript", r"(^|/)chatlog(/|$)"),
    ("session journal", r"(^|/)sessions(/|$)"),
    ("context export", r"(^|/)context-export(/|$)"),
    ("tool state", r"(^|/)\.chatman(/|$)"),
    ("profile transcript", r"\.jsonl$"),
    ("environment file", r"(^|/)\.env(\.|$)|(^|/)\.env$"),
    ("private key", r"(^|/)(id_rsa|id_ed25519|id_ecdsa)(\.|$)"),
    ("key container", r"\.(pem|pfx|p12|keystore)$"),
)

# Forbidden content (name, pattern, whether it is transcript markup); all matches count.
CONTENT = (
    ("private key body", r"-----BEGIN (RSA |EC |OPENSSH |PGP )?PRIVATE KEY-----", False),
    ("model service key", r"\bsk-ant-[A-Za-z0-9_\-]{16,}", False),
    ("forge token", r"\bgh[pousr]_[A-Za-z0-9]{20,}", False),
    ("cloud key", r"\bAKIA[0-9A-Z]{16}\b", False),
    ("chat token", r"\bxox[baprs]-[A-Za-z0-9\-]{10,}", False),
    ("key as value", r"(?i)\b(password|passwd|secret|api[_-]?key|token)\s*[:=]\s*['\"][^'\"\s]{8,}['\"]", False),
    ("transcript markup", r"(?m)^\s*(USER|ASSISTANT|HUMAN)\s*:", True),
    ("transcript json", r'"role"\s*:\s*"(assistant|user)"', True),
    ("transcript xml", r"(?m)^\s*<(user|assistant)_message>", True),
)

# Extensions that are scanned as text, and the largest file that is.
TEXT_EXTENSIONS = (".md", ".txt", ".py", ".json", ".sh", ".ps1", ".yml", ".yaml", ".toml", ".cfg", ".ini", ".c", ".h", ".cpp", ".js", ".ts", ".html", ".csv", ".rst", "")
MAX_SCAN = 4 << 20

# Marks of executable and of routine content in PDF bytes.
HEAVY = ("/JavaScript", "/JS", "/Launch", "/EmbeddedFile", "/RichMedia", "/XFA")
ROUTINE = ("/OpenAction", "/AA", "/Movie", "/Sound", "/Filespec")

# Patterns of patent names: the number in a file name, the title after code 54 in the
# text, a code before it, and what marks a line in capitals as an identifier.
PATENT_NUMBER = r"\d{7,8}"
PATENT_TITLE = r"[\[(]\s*54\s*[\])]\s*(.{6,120}?)(?:[\[(]\s*\d{2}\s*[\])]|\n\s*\n|\z)"
PATENT_CODE = r"^[\[(]?\s*\d{2}\s*[\])]?\s*"
PATENT_IDENTIFIER = r"\d{3}|^[Uu][Ss]\s?\d"

# Names that say nothing, title prefixes and boilerplate, and codes that speak for themselves.
MUSH = r"^(?:[\d][\d._\-]*|[a-z]{1,3}\d{2,}[a-z]?|\d{4}\.\d{4,5}(?:v\d+)?|[a-z]{1,4}\d{4}|\d{2}-\d{2})$"
EMPTY_TITLE = r"^(microsoft word|untitled|document|scan|без имени|документ|print|pdf|arxiv|\s*)$"
SITE_CRUFT = r"^(скачать|download|бесплатно|free)\s+"
SPEAKS = r"ГОСТ|ОСТ\s|ТУ\s|ISO|IEC|IEEE|ITU|EBU|AES|EN\s?\d|DIN|MIL-"
BOILERPLATE = r"^(draft|preprint|submitted|accepted|typeset|to appear|copyright|©|proceedings of|arxiv|manuscript|version \w+|черновик|препринт)"
MOJIBAKE = "¶ÇÄÓÂÎßÑÏåª³¾®¡£¦¥¬¸À§µ¢©°±²´·¹º»¼½¿×Ø"
PUNCTUATION = ".,:;()[]{}«»\"'—–-+±°%/=*№#"
