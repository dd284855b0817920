"""Text normalisation as Column expressions: names, streets, numbers, identifiers. No Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms, position by position, then those that become two letters.
ACCENTED = "ÀÁÂÃÄÅàáâãäåÈÉÊËèéêëÌÍÎÏìíîïÒÓÔÕÖØòóôõöøÙÚÛÜùúûüÇçÑñÝýÿŸŠšŽžªº"
PLAIN = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOOooooooUUUUuuuuCcNnYyyYSsZzao"
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss"}

# Street types, dropped where they open a name.
STREET_TYPES = (
    "R RUA AV AVE AVENIDA AL ALAMEDA TV TRV TRAV TRAVESSA PC PCA PRC PRACA ROD RODOVIA EST ESTR ESTRADA LG LGO LARGO VD VIADUTO VIA "
    "BC BECO LAD LADEIRA PQ PRQ PARQUE SV SERVIDAO PSG PASSAGEM CJ CONJ CONJUNTO LOT LOTEAMENTO ACESSO MARGINAL CONTORNO"
).split()
# Abbreviated titles and their long forms.
TITLES = {
    "DR": "DOUTOR", "DRA": "DOUTORA", "PROF": "PROFESSOR", "PROFA": "PROFESSORA", "ENG": "ENGENHEIRO", "GAL": "GENERAL",
    "GEN": "GENERAL", "CEL": "CORONEL", "MAL": "MARECHAL", "PE": "PADRE", "STA": "SANTA", "STO": "SANTO", "S": "SAO",
    "CAP": "CAPITAO", "TEN": "TENENTE", "DEP": "DEPUTADO", "SEN": "SENADOR", "VER": "VEREADOR", "PRES": "PRESIDENTE", "MAJ": "MAJOR",
    "DES": "DESEMBARGADOR", "COM": "COMENDADOR", "COMEND": "COMENDADOR", "BRIG": "BRIGADEIRO", "ALM": "ALMIRANTE",
    "MONS": "MONSENHOR", "SGT": "SARGENTO", "CB": "CABO", "SD": "SOLDADO", "VISC": "VISCONDE", "BAR": "BARAO", "CONS": "CONSELHEIRO",
    "MIN": "MINISTRO", "GOV": "GOVERNADOR", "PREF": "PREFEITO", "MME": "MADRE", "NSRA": "NOSSA SENHORA",
}
# Other titles, connectives, and the legal forms that company names lose.
OTHER_TITLES = "ENGENHEIRA FREI DOM D DONA IR IRMA IRMAO N NS NOSSA SENHORA".split()
CONNECTIVES = "DE DA DO DAS DOS E".split()
LEGAL_FORMS = "LTDA ME EPP EIRELI SA S A SS CIA MEI EI SOCIEDADE LIMITADA EMPRESARIA UNIPESSOAL".split()
# Categories of incidents by pattern over normalised text; the first in this order that matches counts.
CATEGORIES = [
    (r"\bALARMES?\b", "outros"),
    (r"\b(ROUBO|ASSALTO|LATROCINIO)\b", "violento"),
    (
        r"\b(HOMICIDIO|LESAO CORPORAL|AGRESSAO|VIAS DE FATO|ESTUPRO|SEQUESTRO|AMEACA|VIOLENCIA|DISPARO DE ARMA|ARMAS? DE FOGO|BRIGA|RIXA)\b",
        "violento",
    ),
    (r"\b(FURTO|ARROMBAMENTO|DANO|DEPREDACAO|VANDALISMO|PICHACAO|INVASAO|RECEPTACAO|ESTELIONATO)\b", "patrimonial"),
    (
        r"\b(ALAGAMENTO|INUNDACAO|ENXURRADA|DESTELHAMENTO|VENDAVAL|GRANIZO|ARVORES?|DESLIZAMENTO|DESABAMENTO|INCENDIO|FOGO"
        r"|RISCO ESTRUTURAL|DEFESA CIVIL)\b",
        "fisico",
    ),
    (r"\b(ACIDENTE|TRANSITO|ATROPELAMENTO|COLISAO|EMBRIAGUEZ AO VOLANTE)\b", "transito"),
    (
        r"\b(PERTURBACAO|SOSSEGO|SOM|EMBRIAGUEZ|ENTORPECENTE|DROGAS?|TRAFICO|AMBULANTE|COMERCIO IRREGULAR|ATO OBSCENO|DESORDEM"
        r"|MORADOR DE RUA|SITUACAO DE RUA)\b",
        "ordem_publica",
    ),
]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def words_in(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def norm_text(c: Column | str) -> Column:
    """Upper-case letters without accents and digits, single blanks between; null where nothing remains."""
    out = F.translate(F.coalesce(col(c), F.lit("")), ACCENTED, PLAIN)
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return blank_to_null(F.regexp_replace(F.upper(out), "[^A-Z0-9]+", " "))


def street_words(c: Column | str) -> Column:
    """Words of a street name without the street types that open it; the last word always stays."""
    words = F.split(norm_text(c), " ")
    place = F.transform(words, lambda w, i: F.when(~F.array_contains(words_in(STREET_TYPES), w), i))
    lead = F.coalesce(F.array_min(place), F.size(words) - 1)
    return F.slice(words, F.least(lead, F.size(words) - 1) + 1, F.size(words))


def _joined(kept: Column, words: Column) -> Column:
    return F.array_join(F.when(F.size(kept) == 0, words).otherwise(kept), " ")


def street_key(c: Column | str) -> Column:
    """Short key: neither titles nor connectives; all words where none would remain."""
    words = street_words(c)
    gone = [*TITLES, *TITLES.values(), *OTHER_TITLES, *CONNECTIVES]
    return _joined(F.filter(words, lambda w: ~F.array_contains(words_in(gone), w)), words)


def street_full_key(c: Column | str) -> Column:
    """Full key: titles in their long form, no connectives; all words where none would remain."""
    words = street_words(c)
    long = F.create_map(*(F.lit(x) for pair in TITLES.items() for x in pair))
    kept = F.filter(words, lambda w: ~F.array_contains(words_in(CONNECTIVES), w))
    return _joined(F.transform(kept, lambda w: F.coalesce(F.element_at(long, w), w)), words)


def company_name(c: Column | str) -> Column:
    """A company's name without long numbers, legal forms and connectives; null where nothing remains."""
    words = F.split(norm_text(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[0-9.\-/]{11,}", " ")), " ")
    return F.nullif(F.array_join(F.filter(words, lambda w: ~F.array_contains(words_in(LEGAL_FORMS + CONNECTIVES), w)), " "), F.lit(""))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")


def house_number(c: Column | str) -> Column:
    """First run of digits, six at most; null for none and 0."""
    first = F.regexp_extract(F.coalesce(col(c), F.lit("")), "[0-9]+", 0)
    return F.nullif(F.left(F.nullif(first, F.lit("")), F.lit(6)).cast("int"), F.lit(0))


def postal_code(c: Column | str) -> Column:
    """Exactly eight digits, not all 0."""
    d = digits(c)
    return F.when((F.length(d) == 8) & (d != "00000000"), d)


def activity_code(c: Column | str) -> Column:
    """Exactly seven digits."""
    d = digits(c)
    return F.when(F.length(d) == 7, d)


def person_id_in(c: Column | str) -> Column:
    """First 11-digit person number in a text, plain or punctuated, not part of a longer number."""
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?<![0-9])([0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2})(?![0-9])", 1)
    return F.nullif(digits(found), F.lit(""))


def masked_person_id(c: Column | str) -> Column:
    """Only the middle six digits of an 11-digit number stay readable."""
    x = col(c)
    return F.when(x.rlike("^[0-9]{11}$"), F.concat(F.lit("***."), F.substring(x, 4, 3), F.lit("."), F.substring(x, 7, 3), F.lit("-**")))


def redacted(c: Column | str) -> Column:
    """Free text with every person number starred out."""
    return F.regexp_replace(col(c), r"(?<![0-9])[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}(?![0-9])", "***")


def company_id(c: Column | str, only_companies: bool = False) -> Column:
    """A 14-digit company number with valid check digits (modulo 11), not all zeros. In a column that holds company numbers only, numbers of
    9 to 13 digits get their lost leading zeros back and 8 digits are a root; elsewhere shorter numbers may be person numbers."""
    d = digits(c)
    padded = F.when(F.length(d) == 14, d)
    if only_companies:
        padded = F.when(F.length(d).between(9, 14), F.lpad(d, 14, "0"))

    def check(text: Column, weights: list[int]) -> Column:
        total = sum((F.substring(text, i + 1, 1).cast("int") * w for i, w in enumerate(weights)), F.lit(0))
        return F.when(total % 11 < 2, 0).otherwise(11 - total % 11)

    first = [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
    ok = (check(padded, first) == F.substring(padded, 13, 1).cast("int")) & (check(padded, [6, *first]) == F.substring(padded, 14, 1).cast("int"))
    out = F.when(ok & (padded != "0" * 14), padded)
    return F.when(F.length(d) == 8, d).otherwise(out) if only_companies else out


def category(c: Column | str, rules: list[tuple[str, str]] = CATEGORIES) -> Column:
    """Category of the first rule whose pattern matches the normalised text; `outros` for other text, null for blank."""
    text = norm_text(c)
    hits = [F.when(text.rlike(p), F.lit(k)) for p, k in rules]
    return F.coalesce(*hits, F.when(F.nullif(F.trim(col(c)), F.lit("")).isNotNull(), F.lit("outros")))


def trigrams(c: Column | str) -> Column:
    """Distinct letter trigrams of the words of a text, each padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(
        F.flatten(
            F.transform(
                words,
                lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))),
            )
        )
    )


def set_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays without repeats, in single precision as ranked thresholds expect; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(0.0)).otherwise(both / union).cast("float")


def similarity(a: Column | str, b: Column | str) -> Column:
    """Trigram similarity of two texts."""
    return set_similarity(trigrams(a), trigrams(b))


def best_similarity(left: list[Column | str], right: list[Column | str]) -> Column:
    """The highest similarity of any of some names with any of others; 0 where none can be compared."""
    return F.greatest(F.lit(0.0).cast("float"), *(F.coalesce(similarity(a, b), F.lit(0.0).cast("float")) for a in left for b in right))


def header(name: str) -> str:
    """A file's column name as upper-case ASCII letters, digits and underscores."""
    import re
    import unicodedata

    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^A-Z0-9]+", "_", plain.upper()).strip("_")
