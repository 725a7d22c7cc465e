"""Fixed rule tables. Every job takes these as default arguments, never as globals."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: directory layout -----------------------------------------
PROTECTED_DIR = "PROTECTED"
GENERAL_DIR = "GENERAL"
RAW_DIR = "raw"
PROCESSED_DIR = "processed"
METADATA_SUFFIX = "_metadata.csv"

# --- fixed values: networks and cohorts -------------------------------------
NETWORKS = ("ProNET", "PRESCIENT")
NETWORK_ALIASES = {"pronet": "ProNET", "prescient": "PRESCIENT"}
ALL_NETWORKS = "AllNetworks"
COHORTS = ("CHR", "HC")
RECRUITED = "recruited"

# --- fixed values: modalities that can be plotted ---------------------------
KNOWN_MODALITIES = ("actigraphy", "surveys", "mri", "eeg", "phone", "interviews")

# --- fixed values: study metadata file --------------------------------------
REQUIRED_FIELDS = ("Subject ID", "Active", "Consent", "Study")

# --- fixed values: text that a CSV reader takes for a missing value ---------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

DEFAULT_DAYS = 14
WEEKEND_LABEL_SHARE = 0.05
AXIS_HEADROOM = 1.1


@dataclass(frozen=True)
class Scope:
    """Which protection level and stage of a modality the reports look at."""

    is_protected: bool
    is_raw: bool
    qualifier: str


# --- fixed values: report scope ---------------------------------------------
DEFAULT_SCOPE = Scope(True, True, "")
SCOPES = {"interviews": Scope(False, False, "- (GENERAL, processed)")}


@dataclass(frozen=True)
class TagRule:
    """A file of `modality` whose name matches gets `key` = `value`."""

    modality: str
    match: str  # "suffix" or "substring"
    text: str
    key: str
    value: str


# --- fixed values: file-name tags, first match wins -------------------------
TAG_FILE_SUFFIX = ".json"
TAG_RULES = (
    TagRule("surveys", "suffix", "UPENN_nda.json", "redcap_instance", "UPENN"),
    TagRule("surveys", "suffix", "Pronet.json", "redcap_instance", "MGB-Pronet"),
    TagRule("surveys", "suffix", "Prescient.json", "redcap_instance", "MGB-Prescient"),
    TagRule("phone", "substring", "_sensor_", "mindlamp_type", "sensor"),
    TagRule("phone", "substring", "_activity_", "mindlamp_type", "activity"),
)


@dataclass(frozen=True)
class SubType:
    """Files of `modality` whose tag `key` contains `value` also count as a sub-type."""

    modality: str
    key: str
    value: str

    @property
    def label(self) -> str:
        return f"{self.modality}_{self.value}"


# --- fixed values: sub-types, in report order -------------------------------
SUB_TYPES = (
    SubType("phone", "mindlamp_type", "sensor"),
    SubType("phone", "mindlamp_type", "activity"),
    SubType("surveys", "redcap_instance", "UPENN"),
    SubType("surveys", "redcap_instance", "MGB"),
)
