"""Configuration for the taxonomy engine.

Everything tunable lives in :class:`TaxonomyConfig`. The values below that must
equal the original script's for identical results are grouped under the
"fixed values" comment, stated plainly and in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original taxonomy script for identical results)
# ---------------------------------------------------------------------------

NEEDED_COLUMNS = (
    "company_name", "website_url", "ai_summary", "industry", "services", "market_focus",
    "roles", "customer_types", "product_categories", "customers_segments", "business_model",
    "certifications", "keywords", "location",
)

EXPORT_BASE_COLUMNS = (
    "company_name", "website_url", "ai_summary", "industry", "services", "market_focus",
    "roles", "customer_types", "product_categories", "customers_segments", "business_model",
    "certifications", "keywords",
)

BASE_K_BROAD = (6, 8, 10)
BASE_K_SUB = (8, 12, 18)
BASE_K_NICHE = (6, 10, 14)

KRANGE_BROAD = (6, 14)
KRANGE_SUB = (6, 24)
KRANGE_NICHE = (4, 16)

PCA_DIMS = {"v1": 128, "v2": 96, "v3": 64, "v4": 48, "v5": 64, "vloc": 32}

VIEW_WEIGHTS = {"v1": 0.55, "v2": 0.16, "v3": 0.10, "v5": 0.08, "v4": 0.06, "vloc": 0.05}

CONCAT_ORDER = ("v1", "v2", "v3", "v5", "v4", "vloc")

LABEL_BUDGET = 1200
CACHE_VERSION = "mvsem-v10-labels-2025-09-26"
MAX_LABEL_WORDS = 5

STOPWORDS = (
    "a an and or the of for to with by in on at from into over under between among within across via per "
    "as is are be been being about plus include includes including provide provides providing offered offering "
    "solution solutions product products system systems equipment company ltd limited plc group global international"
).split()

GENERIC_BAN = ("general", "misc", "others", "services", "solutions", "systems", "products", "company", "group")

ACRONYMS = (
    "BMS", "PLC", "SCADA", "HVAC", "NDT", "PV", "UAV", "API", "QA", "QC", "FM200", "CO2", "VMS", "PSIM",
    "HMI", "DCS", "RTU", "VFD", "LV", "MV", "RFID", "CCTV", "IP", "RO", "STP", "ETP", "AHU", "VRF", "VRV",
)

BROAD_UMBRELLAS = (
    "Testing & Inspection",
    "Fire & Life Safety",
    "Security & Surveillance",
    "Industrial Automation",
    "HVAC & Building Services",
    "Water & Environmental",
    "Power & Energy",
    "Marine & Offshore",
    "Defence & Security",
    "Real Estate & Property",
    "Publishing & Media",
    "Automotive Retail",
)

# (pattern, umbrella sector), first match wins
BROAD_RULES = (
    (r"\b(calibration|metrology|ndt|non destructive|inspection|testing|laborator(y|ies))\b", "Testing & Inspection"),
    (r"\b(fire alarm|fire detection|fire suppression|sprinkler|fm200|novec|inergen|hydrant|smoke control)\b", "Fire & Life Safety"),
    (r"\b(cctv|video surveillance|access control|intrusion|perimeter|vms|psim|genetec|avigilon|milestone)\b", "Security & Surveillance"),
    (r"\b(plc|scada|rtu|dcs|hmi|automation|vfd|servo|robot|cobot|bms)\b", "Industrial Automation"),
    (r"\b(hvac|ventilation|ahu|vrf|vrv|chiller|boiler|heat pump|refrigeration)\b", "HVAC & Building Services"),
    (r"\b(wastewater|sewage|stp|etp|water treatment|reverse osmosis|ro|desalination|ultrafiltration)\b", "Water & Environmental"),
    (r"\b(power systems|substation|switchgear|mv|lv|power quality|solar pv|photovoltaic|inverter|renewable)\b", "Power & Energy"),
    (r"\b(marine|offshore|vessel|ship|yacht|nautical)\b", "Marine & Offshore"),
    (r"\b(defen[cs]e|military|security consulting|intelligence)\b", "Defence & Security"),
    (r"\b(real estate|property management|serviced accommodation|landlord|lettings|estate agent)\b", "Real Estate & Property"),
    (r"\b(publishing|small press|books|print production|media|journal)\b", "Publishing & Media"),
    (r"\b(motorhome|caravan|campervan|automotive dealer|used cars)\b", "Automotive Retail"),
)
BROAD_DEFAULT = "Specialist Sector"

# (pattern, canonical head), first match wins
HEAD_RULES = (
    (r"\b(fire alarm|addressable alarm|conventional alarm)\b", "Fire Alarm"),
    (r"\b(fire suppression|foam system|gas suppression|fm200|novec|inergen|co2 system)\b", "Fire Suppression"),
    (r"\b(fire protection|sprinkler|hydrant|hose reel|deluge|preaction)\b", "Fire Protection"),
    (r"\b(smoke control|smoke extraction|pressurization)\b", "Smoke Control"),
    (r"\b(cctv|video surveillance|ip camera|nvr|dvr)\b", "Video Surveillance"),
    (r"\b(access control|turnstile|rfid reader|biometric|bio metric)\b", "Access Control"),
    (r"\b(intrusion alarm|burglar alarm|perimeter security)\b", "Intrusion Alarm"),
    (r"\b(psim|vms|milestone|genetec|avigilon)\b", "Security Integration"),
    (r"\b(plc|ladder logic|iec 61131|rtu|dcs)\b", "PLC"),
    (r"\b(scada|wincc|ifix|ignition|factorytalk|hmi)\b", "SCADA"),
    (r"\b(vfd|drive|servo|motion control)\b", "Drives"),
    (r"\b(robot|cobot|pick and place)\b", "Robotics"),
    (r"\b(bms|building management system)\b", "BMS"),
    (r"\b(hvac|chiller|air handling unit|ahu|vrf|vrv|ducting|ventilation)\b", "HVAC"),
    (r"\b(heat pump|boiler|burner)\b", "Heating"),
    (r"\b(cold room|refrigeration)\b", "Refrigeration"),
    (r"\b(wastewater|sewage|effluent|stp|etp|waste water)\b", "Wastewater Treatment"),
    (r"\b(ultrafiltration|reverse osmosis|ro plant|demineralization|softener)\b", "Water Treatment"),
    (r"\b(desalination)\b", "Desalination"),
    (r"\b(calibration|metrology|gauges|dimensional|mass calibration|flow calibration)\b", "Calibration"),
    (r"\b(ndt|non destructive|ultrasonic testing|radiography|magnetic particle|penetrant)\b", "NDT"),
    (r"\b(materials testing|tensile|hardness|metallography|microstructure)\b", "Materials Testing"),
    (r"\b(environmental testing|emissions|stack monitoring|air quality|water testing)\b", "Environmental Testing"),
    (r"\b(electrical testing|hipot|insulation resistance|relay testing)\b", "Electrical Testing"),
    (r"\b(structural|civil engineering|geotech|rebar|concrete testing)\b", "Civil & Structural"),
    (r"\b(lifting equipment|cranes|hoists|eot)\b", "Lifting Equipment"),
    (r"\b(solar pv|photovoltaic|inverter|string combiner)\b", "Solar PV"),
    (r"\b(power quality|switchgear|substation|mv|lv)\b", "Power Systems"),
    (r"\b(marine|offshore|vessel|ship)\b", "Marine"),
    (r"\b(corrosion|coating|blasting|painting)\b", "Corrosion Protection"),
    (r"\b(biotech|biotechnology|pharma|pharmaceutical)\b", "Biotechnology"),
    (r"\b(cybersecurity|soc|siem)\b", "Cybersecurity"),
)
HEAD_DEFAULT = "Specialist"

VALID_SUFFIXES = (
    "Manufacturers", "Suppliers & Distributors", "Suppliers", "Distributors",
    "Installers", "Integrators", "Service Providers", "Consultants", "Contractors",
    "Calibration Labs", "NDT Labs", "Environmental Testing Labs", "Materials Testing Labs", "Electrical Test Labs",
    "Specialists", "Platforms", "Associations", "Retailers", "Equipment",
)

# suffixes stripped from Broad labels (no Retailers / Equipment here)
BROAD_STRIP_SUFFIXES = (
    "Manufacturers", "Suppliers & Distributors", "Suppliers", "Distributors", "Installers", "Integrators",
    "Service Providers", "Consultants", "Contractors", "Calibration Labs", "NDT Labs",
    "Environmental Testing Labs", "Materials Testing Labs", "Electrical Test Labs", "Platforms",
    "Associations", "Specialists",
)

ROLE_HINTS = (
    ("manufacturer", "Manufacturers"),
    ("supplier", "Suppliers & Distributors"),
    ("distributor", "Suppliers & Distributors"),
    ("installer", "Installers"),
    ("integrator", "Integrators"),
    ("consultant", "Consultants"),
    ("contractor", "Contractors"),
    ("service", "Service Providers"),
    ("association", "Associations"),
    ("platform", "Platforms"),
)

# (substring stem, role), each stem counts at most once per cluster
ROLE_STEMS = (
    ("install", "installer"), ("commission", "installer"),
    ("integrat", "integrator"),
    ("wholesale", "supplier"), ("distribut", "supplier"), ("stockist", "supplier"), ("resell", "supplier"),
    ("retail", "supplier"),
    ("manufactur", "manufacturer"), ("fabricat", "manufacturer"), ("producer", "manufacturer"),
    ("oem", "manufacturer"),
    ("consult", "consultant"), ("advis", "consultant"), ("assessment", "consultant"), ("survey", "consultant"),
    ("contract", "contractor"),
    ("maintenance", "service"), ("servicing", "service"), ("calibration", "service"), ("testing", "service"),
    ("laboratory", "service"), (" lab ", "service"),
    ("membership", "association"), ("trade association", "association"), ("federation", "association"),
    ("society", "association"), ("institute", "association"), ("council", "association"),
    ("platform", "platform"), ("marketplace", "platform"),
)

# (pattern, lab suffix), checked before the role-based suffix
LAB_SUFFIX_RULES = (
    (r"\b(calibration|metrology)\b", "Calibration Labs"),
    (r"\b(ndt|non destructive|ultrasonic testing|radiography|magnetic particle|penetrant)\b", "NDT Labs"),
    (r"\b(environmental testing|emissions|stack monitoring|air quality|water testing)\b", "Environmental Testing Labs"),
    (r"\b(materials testing|metallography|tensile|hardness)\b", "Materials Testing Labs"),
    (r"\b(electrical testing|hipot|insulation resistance|relay testing)\b", "Electrical Test Labs"),
)

# profile caps: first n non-blank values per cluster, by row id
PROFILE_CAPS = {"industries": 12, "services": 16, "summaries": 12, "company_names": 8, "business_models": 12}
TOP_KEYWORDS = 40

# pandas' default spellings of a missing CSV value
CSV_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class LevelConfig:
    name: str                 # "Broad" | "Sub" | "Niche"
    base_k: tuple             # graph k-set before adaptive scaling
    krange: tuple             # (kmin, kmax) searched by choose_k
    max_big_frac: float       # size limit of the largest cluster in choose_k
    min_size_floor: int       # merge_small: max(floor, frac * n)
    min_size_frac: float
    dup_threshold: float      # merge_duplicates similarity threshold
    min_group: int = 0        # parents smaller than this are not split


BROAD = LevelConfig("Broad", BASE_K_BROAD, KRANGE_BROAD, 0.35, 12, 0.003, 0.998)
SUB = LevelConfig("Sub", BASE_K_SUB, KRANGE_SUB, 0.42, 8, 0.002, 0.999, min_group=5)
NICHE = LevelConfig("Niche", BASE_K_NICHE, KRANGE_NICHE, 0.50, 6, 0.002, 0.9992, min_group=4)
LEVELS = {"Broad": BROAD, "Sub": SUB, "Niche": NICHE}


@dataclass(frozen=True)
class TaxonomyConfig:
    view_weights: dict = field(default_factory=lambda: dict(VIEW_WEIGHTS))
    pca_dims: dict = field(default_factory=lambda: dict(PCA_DIMS))
    concat_order: tuple = CONCAT_ORDER
    sigma_k: int = 7                    # local scale = distance to neighbour min(sigma_k, k)
    mutual_weight: float = 0.65         # blend of mutual heat graph and SNN graph
    snn_weight: float = 0.35
    eig_cap: int = 48                   # hard cap on eigenvectors
    eig_kmax_cap: int = 32              # kmax passed to the embedding: min(krange max, 32)
    sample_cap: int = 7000              # choose_k sample per group
    kmeans_restarts: int = 20
    kmeans_max_iter: int = 300
    kmeans_tol: float = 1e-4
    seed: int = 42
    refine_margin_v1: float = 0.025
    refine_margin_concat: float = 0.015
    label_budget: int | None = None     # proposals asked for at most; None: every cluster (LABEL_BUDGET is the original's)
    compat_word_cap: bool = True        # keep the original head/suffix word cap
    strict_umbrella: bool = False       # Broad labels always a sector: one of BROAD_UMBRELLAS or the default
    text_encoder: str = "hashing"       # default encoder: "hashing" (text_features words, PCA) or "projection" (any vocabulary)
    text_features: int = 1024           # hashed words of the default encoder (its PCA holds the square of this)
    # physical knobs (not semantics)
    knn_block_rows: int = 2048          # rows per kNN block
    knn_method: str = "exact"           # "exact" (reference semantics) or "lsh" (opt-in, approximate)
    lsh_tables: int = 8
    lsh_bits: int = 8
    eig_oversample: int = 24            # extra block columns in the eigensolver
    eig_cheb_degree: int = 10           # products in one filter step
    eig_max_outer: int = 40             # filter steps before the eigensolver raises
    eig_tol: float = 1e-6               # largest residual norm of a wanted eigenpair


DEFAULT_CONFIG = TaxonomyConfig()
