"""Column masking: keyed hash, static, partial, pseudonyms, noise.

Every rule is a built-in column expression: NULL stays NULL, nothing leaves
the JVM, and masking never adds a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakestrata import constants as K
from lakestrata.functions.permute import once, permuted, permuted_digits

# Word pools of the pseudonyms (fixed values).
FIRST_NAMES = [
    "Alice", "Ana", "Antonio", "Beatriz", "Bruno", "Camila", "Carlos", "Daniel",
    "Eduardo", "Fernanda", "Gabriel", "Helena", "Isabela", "Joao", "Julia", "Larissa",
    "Lucas", "Marcos", "Maria", "Mateus", "Paulo", "Rafael", "Sofia", "Vitor",
]
LAST_NAMES = [
    "Almeida", "Alves", "Araujo", "Barbosa", "Cardoso", "Carvalho", "Castro", "Costa",
    "Dias", "Fernandes", "Ferreira", "Gomes", "Lima", "Lopes", "Martins", "Melo",
    "Moreira", "Oliveira", "Pereira", "Ribeiro", "Rocha", "Santos", "Silva", "Souza",
]
STREETS = [
    "Rua das Flores", "Rua do Sol", "Rua da Paz", "Avenida Central",
    "Avenida Brasil", "Travessa do Porto", "Alameda dos Anjos", "Largo da Matriz",
]
AREA_CODES = ["11", "21", "31", "41", "51", "61", "71", "81", "85", "91"]
WORDS = [
    "areia", "barco", "campo", "dia", "estrela", "folha", "gato", "horta",
    "ilha", "jardim", "lago", "mar", "noite", "onda", "pedra", "rio",
]
KIND_BY_COLUMN = {
    "email": "email",
    "nome": "name", "name": "name",
    "endereco": "address", "address": "address",
    "telefone": "phone", "phone": "phone",
    "cpf": "cpf",
}


def mask_hash(col: Column, key: str) -> Column:
    """Lower-case hex SHA-256 of the text followed by the key."""
    if not key:
        raise ValueError("masking key is required")
    return F.sha2(F.concat(col.cast("string"), F.lit(key)), 256)


def mask_static(col: Column, value: str = K.STATIC_MASK) -> Column:
    return F.when(col.isNotNull(), F.lit(value))


def mask_partial(col: Column, start_len: int = 0, end_len: int = 0, mask_char: str = "*") -> Column:
    """Keep the ends, fill the middle; short values are masked whole."""
    for n in (start_len, end_len):
        if not isinstance(n, int) or isinstance(n, bool) or n < 0:
            raise ValueError("start_len and end_len must be non-negative integers")
    text = col.cast("string")
    size = F.length(text)
    kept = start_len + end_len
    middle = F.repeat(F.lit(str(mask_char)), size - kept)
    return F.when(size <= kept, F.repeat(F.lit(str(mask_char)), size)).otherwise(
        F.concat(F.substring(text, 1, start_len), middle, F.right(text, F.lit(end_len)))
    )


def _digest_number(digest: Column, slot: int) -> Column:
    """Eight hex digits of the digest as a number; slots 0..7 are independent."""
    return F.conv(F.substring(digest, slot * 8 + 1, 8), 16, 10).cast("bigint")


def _pick(words: list[str], number: Column) -> Column:
    # ``get`` keeps a NULL index NULL; ``element_at`` does not.
    return F.get(F.array(*map(F.lit, words)), (number % len(words)).cast("int"))


def _padded(number: Column, width: int) -> Column:
    return F.lpad((number % 10 ** width).cast("string"), width, "0")


def _cpf(base: Column) -> Column:
    """A number of nine digits with the two modulo-11 check digits.

    With digits d0..d8 the first check digit weighs them 10 down to 2 and the
    second 11 down to 3 plus twice the first, so both follow from two sums.
    """
    digits = [F.floor(base / 10 ** (8 - i)).cast("int") % 10 for i in range(9)]
    plain_sum = sum(digits[1:], start=digits[0])
    weighted = sum((d * (10 - i) for i, d in enumerate(digits)), start=F.lit(0))
    first = weighted * 10 % 11 % 10
    second = (weighted + plain_sum + first * 2) * 10 % 11 % 10
    text = _padded(base, 9)
    return F.concat(
        F.substring(text, 1, 3), F.lit("."), F.substring(text, 4, 3), F.lit("."), F.substring(text, 7, 3),
        F.lit("-"), first.cast("string"), second.cast("string"),
    )


def mask_pseudonym(col: Column, kind: str, key: str) -> Column:
    """Deterministic replacement: one value and key always give one pseudonym.

    ``kind`` is a kind (name, email, address, phone, cpf, word) or a column
    name that stands for one; anything else gives a word, as does no match.
    Emails, phones and CPFs carry enough digits to keep collisions rare; names
    and words are drawn from small pools and do collide by design.
    """
    if not key:
        raise ValueError("masking key is required")
    kind = KIND_BY_COLUMN.get(kind, kind)
    digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), col.cast("string")), 256)
    n = [_digest_number(digest, slot) for slot in range(4)]
    if kind == "name":
        out = F.concat(_pick(FIRST_NAMES, n[0]), F.lit(" "), _pick(LAST_NAMES, n[1]))
    elif kind == "email":
        out = F.concat(
            F.lower(_pick(FIRST_NAMES, n[0])), F.lit("."), F.lower(_pick(LAST_NAMES, n[1])),
            _padded(n[2], 6), F.lit("@example.com.br"),
        )
    elif kind == "address":
        out = F.concat(
            _pick(STREETS, n[0]), F.lit(", "), (n[1] % 2000 + 1).cast("string"), F.lit(" - "), _padded(n[2], 8)
        )
    elif kind == "phone":
        out = F.concat(
            F.lit("+55 "), _pick(AREA_CODES, n[0]), F.lit(" 9"), _padded(n[1], 4), F.lit("-"), _padded(n[2], 4)
        )
    elif kind == "cpf":
        out = _cpf(_digest_number(digest, 0) % 10 ** 9)
    else:
        out = _pick(WORDS, n[0])
    return out


# Form of a value, and the number in it that is permuted.
PERMUTED_FORMS = {
    "cpf": r"^\s*(\d{3})\.?(\d{3})\.?(\d{3})-?\d{2}\s*$",
    "phone": r"^(.*?)(\d{4})[ -]?(\d{4})\s*$",
    "numbered": r"^(\D*)(\d{1,15})(\D*)$",
}


def mask_permuted(col: Column, kind: str, key: str) -> Column:
    """Pseudonyms that never meet: different values get different ones.

    ``cpf``: the nine digits are permuted and get check digits anew. ``phone``:
    the last eight digits are permuted, what stands before them stays, so
    phones differ as their area codes do. ``numbered``: the only number in the
    text is permuted among those of as many digits, as in customer codes; the
    text around it stays. A value of another form gets its keyed hash.
    """
    if not key:
        raise ValueError("masking key is required")
    if kind not in PERMUTED_FORMS:
        raise ValueError(f"kind is one of {', '.join(PERMUTED_FORMS)}")
    text, form = col.cast("string"), PERMUTED_FORMS[kind]
    secret = f"{key}|{kind}"

    def masked(part: Column) -> Column:
        if kind == "cpf":
            return once(permuted(F.concat(part["p1"], part["p2"], part["p3"]), 10 ** 9, secret), _cpf)
        if kind == "phone":
            new = F.lpad(permuted(F.concat(part["p2"], part["p3"]), 10 ** 8, secret).cast("string"), 8, "0")
            return once(new, lambda n: F.concat(part["p1"], F.substring(n, 1, 4), F.lit("-"), F.substring(n, 5, 4)))
        width = F.length(part["p2"])
        new = F.lpad(permuted_digits(part["p2"], width, secret).cast("string"), width, F.lit("0"))
        return F.concat(part["p1"], new, part["p3"])

    # The parts and the permuted number are used several times: computed once.
    parts = F.struct(*[F.regexp_extract(text, form, n).alias(f"p{n}") for n in (1, 2, 3)])
    return F.when(text.rlike(form), once(parts, masked)).otherwise(mask_hash(text, key))


def laplace_noise(
    df: DataFrame,
    column: str,
    epsilon: float,
    sensitivity: float,
    seed: int | None = None,
    noise_key: tuple[str | Sequence[str], str] | None = None,
) -> DataFrame:
    """Add Laplace(0, sensitivity / epsilon) noise to each value.

    ``noise_key=(id_columns, secret)`` draws the noise from a keyed digest of
    the row's identity instead of ``rand``: repeatable whatever the
    partitioning. The columns must tell rows apart; rows that agree in all of
    them share a draw, and the differences of their values would be exact.
    Noise per row protects single values; it is no guarantee for aggregates
    that are computed afterwards from the same column.
    """
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    if not isinstance(df.schema[column].dataType, T.NumericType):
        raise ValueError(f"column {column!r} is not numeric")
    for name, number in (("epsilon", epsilon), ("sensitivity", sensitivity)):
        if isinstance(number, bool) or not isinstance(number, (int, float)):
            raise ValueError(f"{name} must be a number")
    if not epsilon > 0:
        raise ValueError("epsilon must be positive")
    if not sensitivity >= 0:
        raise ValueError("sensitivity must not be negative")
    if noise_key:
        row_id, secret = noise_key
        unit = keyed_unit([row_id] if isinstance(row_id, str) else row_id, secret)
    else:
        unit = F.rand() if seed is None else F.rand(seed)
    return df.withColumn(column, F.col(column).cast("double") + laplace(unit, sensitivity / epsilon))


def keyed_unit(columns: Sequence[str], secret: str) -> Column:
    """A number between 0 and 1 from a keyed digest of the columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.sha2(F.concat(F.concat_ws("|", *parts), F.lit(secret)), 256)
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double")
    return (bits + 0.5) / float(2 ** 52)


def laplace(unit: Column, scale: float) -> Column:
    """Laplace(0, scale) noise from a uniform number between 0 and 1."""
    u = unit - 0.5
    tail = F.greatest(1 - 2 * F.abs(u), F.lit(2.0 ** -53))
    return -F.signum(u) * F.log(tail) * F.lit(float(scale))


@dataclass(frozen=True)
class MaskRule:
    """How one column is masked, and why."""

    method: str
    options: Mapping[str, object] = field(default_factory=dict)
    reason: str = ""


MaskBuilder = Callable[..., Column]

_BUILDERS: dict[str, MaskBuilder] = {
    "hash": lambda col, name, key: mask_hash(col, key),
    "static": lambda col, name, key, static_value=K.STATIC_MASK: mask_static(col, static_value),
    "partial": lambda col, name, key, **options: mask_partial(col, **options),
    "fake": lambda col, name, key, kind=None: mask_pseudonym(col, kind or name, key),
    "permuted": lambda col, name, key, kind: mask_permuted(col, kind, key),
}


def register_mask(name: str, builder: MaskBuilder) -> None:
    """Add a method: ``builder(col, column_name, key, **options) -> Column``."""
    _BUILDERS[name] = builder


# Personal data of the consolidated sales table (fixed values).
DEFAULT_POLICY = {
    "customer_city": MaskRule("static", {"static_value": K.CITY_MASK}, "specific location"),
    "customer_state": MaskRule("hash", {}, "keeps regional patterns without the region"),
}


def mask_columns(
    df: DataFrame, policy: Mapping[str, MaskRule] = DEFAULT_POLICY, *, key: str, lenient: bool = False
) -> DataFrame:
    """Mask several columns in one projection; the key is required.

    A column of the policy that the table lacks is an error, since the data it
    should protect may be there under another name; ``lenient`` skips it.
    """
    if not key:
        raise ValueError("masking key is required")
    unknown = sorted({rule.method for rule in policy.values()} - _BUILDERS.keys())
    if unknown:
        raise ValueError(f"unknown masking method: {', '.join(unknown)}")
    absent = sorted(set(policy) - set(df.columns))
    if absent and not lenient:
        raise ValueError(f"the table lacks columns of the policy: {', '.join(absent)}")
    masked = {
        name: _BUILDERS[rule.method](F.col(name), name, key, **rule.options)
        for name, rule in policy.items()
        if name in df.columns
    }
    return df.withColumns(masked) if masked else df
