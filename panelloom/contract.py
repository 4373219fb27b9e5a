"""What the engine needs to know about one family of yearly tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Dimension:
    """A versioned dimension: the id is a hash of ``attributes``; the first one is the code."""

    name: str
    attributes: tuple[str, ...]

    @property
    def id(self) -> str:
        return f"id_{self.name}"

    @property
    def code(self) -> str:
        return self.attributes[0]


@dataclass(frozen=True)
class Contract:
    year: str
    identification: tuple[str, ...]
    provenance: tuple[str, ...]
    textual_rates: str
    rate_prefixes: tuple[str, ...]
    entity: str
    place: str
    state: str
    states: tuple[str, ...]
    code_digits: dict[str, int]
    lowest: float
    highest: float
    category: str
    category_names: dict[str, str]
    entities: Dimension
    places: Dimension
    file_pattern: str
    header_aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def is_rate(self, column: str) -> bool:
        return column.startswith(self.rate_prefixes)

    def rates(self, columns: Iterable[str]) -> list[str]:
        return sorted(c for c in columns if self.is_rate(c))

    @property
    def base(self) -> list[str]:
        return [*self.identification, *self.provenance]

    def history_columns(self, inputs: Iterable[Iterable[str]]) -> list[str]:
        """Identification, rates, provenance, other columns, then the reserved text column."""
        names = set().union(*(set(columns) for columns in inputs))
        if self.textual_rates in names:
            raise ValueError(f"Nome reservado na entrada: {self.textual_rates}")
        rates = self.rates(names)
        known = {*self.base, *rates}
        return [*self.identification, *rates, *self.provenance,
                *sorted(names - known), self.textual_rates]


# Column names, code formats, domains and aliases of the school-rate tables.
SCHOOL_RATES = Contract(
    year="ano",
    identification=("ano", "no_regiao", "sg_uf", "co_municipio", "no_municipio",
                    "co_entidade", "no_entidade", "tipoloca", "dependad"),
    provenance=("fonte_arquivo", "fonte_caminho", "fonte_aba"),
    textual_rates="taxas_textuais_origem",
    rate_prefixes=("tap_", "tre_", "tab_"),
    entity="co_entidade",
    place="co_municipio",
    state="sg_uf",
    states=tuple("AC AL AP AM BA CE DF ES GO MA MT MS MG PA PB PR PE PI RJ RN RS RO RR SC SP SE TO".split()),
    code_digits={"co_entidade": 8, "co_municipio": 7},
    lowest=0.0,
    highest=100.0,
    category="dependad",
    category_names={"Particular": "Privada"},
    entities=Dimension("escola", ("co_entidade", "no_entidade", "co_municipio", "no_municipio",
                                  "sg_uf", "no_regiao", "tipoloca", "dependad")),
    places=Dimension("municipio", ("co_municipio", "no_municipio", "sg_uf", "no_regiao")),
    file_pattern=r"taxas_rendimento_(\d{4})\.parquet",
    header_aliases={
        "ano": ("ano", "nu_ano_censo"),
        "no_regiao": ("no_regiao", "regiao"),
        "sg_uf": ("sg_uf", "uf"),
        "co_municipio": ("co_municipio", "codigo_do_municipio"),
        "no_municipio": ("no_municipio", "nome_do_municipio"),
        "co_entidade": ("co_entidade", "codigo_da_escola"),
        "no_entidade": ("no_entidade", "nome_da_escola"),
        "tipoloca": ("tipoloca", "localizacao", "no_categoria"),
        "dependad": ("dependad", "rede", "dependencia_administrativa", "no_dependencia"),
    },
)
