"""Parameters of the engine, with the values a news run uses by default."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from gaceta.operators.membership import IndexParams

# --- Fixed values: results depend on these lists being exactly as stated. ---

GAZETTEER: dict[str, tuple[str, ...]] = {
    "Arica y Parinacota": ("arica", "parinacota", "xv region", "region de arica"),
    "Tarapaca": ("tarapaca", "iquique", "alto hospicio", "i region", "primera region"),
    "Antofagasta": (
        "antofagasta", "calama", "tocopilla", "mejillones", "taltal",
        "ii region", "segunda region",
    ),
    "Atacama": (
        "atacama", "copiapo", "vallenar", "chanaral", "huasco",
        "iii region", "tercera region",
    ),
    "Coquimbo": (
        "coquimbo", "la serena", "ovalle", "illapel", "los vilos",
        "iv region", "cuarta region",
    ),
    "Valparaiso": (
        "valparaiso", "vina del mar", "quilpue", "villa alemana", "san antonio",
        "quillota", "los andes", "quintero", "limache", "v region", "quinta region",
    ),
    "Metropolitana": (
        "santiago", "region metropolitana", "metropolitana", "rm", "maipu", "nunoa",
        "providencia", "las condes", "la florida", "penalolen", "pudahuel",
        "estacion central", "macul", "puente alto", "san bernardo",
    ),
    "OHiggins": (
        "ohiggins", "o'higgins", "rancagua", "san fernando", "pichilemu",
        "santa cruz", "vi region", "sexta region",
    ),
    "Maule": (
        "maule", "talca", "curico", "linares", "cauquenes", "constitucion",
        "vii region", "septima region",
    ),
    "Nuble": (
        "nuble", "chillan", "san carlos", "bulnes", "xvi region", "region de nuble",
    ),
    "Biobio": (
        "biobio", "concepcion", "conce", "talcahuano", "los angeles", "coronel",
        "lota", "chiguayante", "hualpen", "tome", "viii region", "octava region",
    ),
    "La Araucania": (
        "araucania", "temuco", "villarrica", "pucon", "angol", "victoria",
        "nueva imperial", "ix region", "novena region",
    ),
    "Los Rios": (
        "los rios", "valdivia", "la union", "panguipulli", "xiv region",
        "region de los rios",
    ),
    "Los Lagos": (
        "los lagos", "puerto montt", "osorno", "ancud", "castro", "chiloe",
        "puerto varas", "calbuco", "x region", "decima region",
    ),
    "Aysen": (
        "aysen", "coyhaique", "coihaique", "chile chico", "cochrane",
        "xi region", "undecima region",
    ),
    "Magallanes": (
        "magallanes", "punta arenas", "puerto natales", "torres del paine",
        "xii region", "duodecima region",
    ),
}

UNKNOWN_REGION = "Desconocida"

# region name -> (roman numeral, abbreviation)
REGION_ATTRIBUTES: dict[str, tuple[str, str]] = {
    "Arica y Parinacota": ("XV", "AR"),
    "Tarapaca": ("I", "TA"),
    "Antofagasta": ("II", "AN"),
    "Atacama": ("III", "AT"),
    "Coquimbo": ("IV", "CO"),
    "Valparaiso": ("V", "VA"),
    "Metropolitana": ("RM", "RM"),
    "OHiggins": ("VI", "OH"),
    "Maule": ("VII", "MA"),
    "Nuble": ("XVI", "NB"),
    "Biobio": ("VIII", "BI"),
    "La Araucania": ("IX", "AR2"),
    "Los Rios": ("XIV", "LR"),
    "Los Lagos": ("X", "LL"),
    "Aysen": ("XI", "AY"),
    "Magallanes": ("XII", "MG"),
    "Desconocida": ("—", "??"),
}

STOP_WORDS: tuple[str, ...] = (
    "a", "además", "ahora", "ahí", "al", "ante", "así", "año", "años", "bien",
    "cada", "como", "con", "contra", "cuando", "cómo", "de", "del", "desde",
    "después", "dijo", "donde", "dos", "durante", "día", "días", "e", "el", "ella",
    "en", "entre", "era", "es", "esa", "esas", "ese", "eso", "esos", "esta",
    "estas", "este", "esto", "estos", "está", "están", "fecha", "fue", "fueron",
    "gran", "ha", "había", "hace", "hacer", "han", "hasta", "hay", "hecho",
    "horas", "hoy", "la", "las", "le", "les", "lo", "los", "luego", "lugar", "me",
    "mi", "mientras", "mis", "mismo", "momento", "muy", "más", "ni", "no", "nos",
    "nueva", "nuevo", "o", "otros", "para", "parte", "pasado", "pero", "por",
    "por que", "porque", "puede", "que", "quien", "quienes", "qué", "respecto",
    "se", "sea", "según", "ser", "será", "señaló", "si", "sido", "sin", "sino",
    "sobre", "solo", "son", "su", "sus", "también", "tanto", "te", "tener", "the",
    "tiene", "todo", "todos", "tras", "través", "tres", "tu", "tus", "un", "una",
    "uno", "ver", "vez", "y", "ya",
)

# Monday first.
WEEKDAYS: tuple[str, ...] = (
    "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo",
)

# Field values a CSV reader treats as missing.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Id given to a fact whose source or date has no dimension row.
MISSING_ID = -1

# --- End of fixed values. ---


@dataclass(frozen=True)
class RegionParams:
    """How an article is given a region: weighted place-name hits."""

    gazetteer: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: GAZETTEER)
    default_label: str = UNKNOWN_REGION
    title_weight: int = 3
    body_weight: int = 1
    body_prefix: int = 800

    @property
    def scored(self) -> list[str]:
        """Region names that have aliases, in id order."""
        return [name for name, aliases in self.gazetteer.items() if aliases]

    @property
    def ids(self) -> dict[str, int]:
        names = [*self.gazetteer]
        if self.default_label not in self.gazetteer:
            names.append(self.default_label)
        return {name: i for i, name in enumerate(names, start=1)}

    @property
    def definition(self) -> str:
        """All that the region of an article depends on, as JSON."""
        own = dict(vars(self), gazetteer={n: list(a) for n, a in self.gazetteer.items()})
        return json.dumps(own, ensure_ascii=False, sort_keys=True)


@dataclass(frozen=True)
class TokenParams:
    """What counts as a term."""

    alphabet: str = "a-záéíóúüñ"
    min_length: int = 3
    stop_words: tuple[str, ...] = STOP_WORDS


@dataclass(frozen=True)
class QueryParams:
    """Knobs of the four analytical queries."""

    top_k: int = 20
    region_top: int = 20
    min_freq: int = 10
    window: int = 7
    factor: float = 1.5
    years: tuple[int, int] | None = None


@dataclass(frozen=True)
class Params:
    regions: RegionParams = field(default_factory=RegionParams)
    tokens: TokenParams = field(default_factory=TokenParams)
    query: QueryParams = field(default_factory=QueryParams)
    index: IndexParams = field(default_factory=IndexParams)
    # True: "2023-1-5" and "2023-01-05" are one day. False: key on the text as given.
    canonical_dates: bool = True
