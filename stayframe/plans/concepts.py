"""Fixed values of the study: item ids, code lists and categories.

Everything here must equal the published study definition for equal results.
Operators take these as parameters; ``Concepts`` bundles one set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from stayframe.functions.numeric import INCH_IN_CM
from stayframe.operators.codes import CodeRule, SepsisRule
from stayframe.operators.lookback import Item


def same(label: str, *ids: int, **rule) -> dict[int, Item]:
    """Several item ids that carry one concept under one rule."""
    return {i: Item(label, **rule) for i in ids}


# Arterial blood pressure (systolic, diastolic, mean): first one marks the line.
ARTERIAL_LINE = (51, 6701, 220050, 8368, 8555, 220051, 52, 6702, 220052, 225312)

MEAN_PRESSURE = (456, 52, 6702, 443, 220052, 220181, 225312)

VITALS = {
    **same("MAP", *MEAN_PRESSURE),
    **same("Temperature", 223762, 676),
    **same("Temperature", 223761, 678, shift=32.0, divisor=1.8),
    **same("HeartRate", 211, 220045),
    **same("CVP", 113, 220074),
    **same("SpO2", 646, 220277),
}

LABS = {
    **same("BUN", 51006),
    **same("CHLORIDE", 50806, 50902),
    **same("CREATININE", 50912),
    **same("HEMOGLOBIN", 50811, 51222),
    **same("PLATELET", 51265),
    **same("POTASSIUM", 50822, 50971),
    **same("SODIUM", 50824, 50983),
    **same("TOTALCO2", 50803, 50882, 50804),
    **same("WBC", 51300, 51301),
}

LAB_PANEL = {
    **same("HEMATOCRIT", 50810, 51221),
    **same("WBC", 51300, 51301),
    **same("HEMOGLOBIN", 50811, 51222),
    **same("PLATELET", 51265),
    **same("SODIUM", 50824, 50983),
    **same("POTASSIUM", 50822, 50971),
    **same("TOTALCO2", 50803, 50882, 50804),
    **same("BUN", 51006),
    **same("CREATININE", 50912),
    **same("CHLORIDE", 50806, 50902),
    **same("GLUCOSE", 50809, 50931),
    **same("CALCIUM", 50808),
    **same("MAGNESIUM", 50960),
    **same("PHOSPHATE", 50970),
    **same("AST", 50878),
    **same("ALT", 50861),
    **same("LDH", 50954),
    **same("BILIRUBIN", 50885),
    **same("ALP", 50863),
    **same("ALBUMIN", 50862),
    **same("TROPT", 51003),
    **same("CK", 50910),
    **same("NTBNP", 50963),
    **same("LACTATE", 50813),
}

# Output prefix of a lab label where it differs from the lower-case label.
LAB_NAMES = {"HEMOGLOBIN": "hgb", "TOTALCO2": "tco2"}

# Normal hematocrit range by gender_num (1 male, 0 female).
HEMATOCRIT_RANGE = {1: (44.7, 50.3), 0: (36.1, 44.3)}

# Blood gas; zero and negative values are not plausible.
GAS = {
    **same("SPECIMEN", 50800, above=0.0),
    **same("FIO2", 50816, above=0.0, high=100.0),
    **same("PO2", 50821, above=0.0, high=800.0),
}

# Charted oxygen fraction, to percent.
CHARTED_FIO2 = {
    **same("FIO2", 223835, factor=100.0, above=0.0, high=1.0,
           otherwise=Item("", low=21.0, high=100.0)),
    **same("FIO2", 3420, 3422),
    **same("FIO2", 190, factor=100.0, above=0.20, below=1.0),
}

ORGAN_LABS = {
    **same("BILIRUBIN", 50885, high=150.0),
    **same("CREATININE", 50912, high=150.0),
    **same("PLATELET", 51265, high=10000.0),
}

URINE = (
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096,
    40651, 226559, 226560, 227510, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558,
)

GCS_MOTOR = (454, 223901)
GCS_VERBAL = (723, 223900)
GCS_EYES = (184, 220739)

WEIGHT_ADMIT = same("WEIGHT", 762, 226512)
WEIGHT_DAILY = same("WEIGHT", 763, 224639)
HEIGHT = {
    **same("HEIGHT", 920, 1394, 4187, 3486, factor=INCH_IN_CM),
    **same("HEIGHT", 226730, 3485, 4188),
}

# Vasopressors: norepinephrine, epinephrine, phenylephrine, vasopressin, dopamine, isuprel.
VASOPRESSOR_POINTS = (30047, 30120, 30044, 30119, 30309, 30127, 30128, 30051, 30043, 30307, 30125, 30046)
VASOPRESSOR_INTERVALS = (221906, 221289, 221749, 222315, 221662, 227692)

# Anaesthetics: fentanyl, propofol, midazolam, dilaudid.
ANAESTHETIC_POINTS = (30118, 30149, 30150, 30308, 30131, 30124, 30163)
ANAESTHETIC_INTERVALS = (222168, 227210, 221668, 221833, 221744, 225972, 225942)

# Packed red cells, given on the ward and in the operating room.
RED_CELL_POINTS = {"rbc": [30001, 30004, 30179], "rbc_or": [30104]}
RED_CELL_INTERVALS = {"rbc": [220996, 225168], "rbc_or": [226368, 227070]}

CODE_STATUS_ITEMS = (128, 223758)
CODE_STATUS = {
    "Full Code": "FullCode",
    "Comfort Measures": "CMO",
    "CPR Not Indicate": "DNCPR",
    "CPR Not Indicated": "DNCPR",
    "Do Not Intubate": "DNI",
    "Do Not Resuscita": "DNR",
    "Do Not Resuscitate": "DNR",
}

# Comorbidity codes. Blanks inside the literals are part of the stored codes.
COMORBIDITIES = {
    "endocarditis": CodeRule(exact=(
        "03642", "07422", "09320", "09321", "09322", "09323", "09324", "09884", "11281", "11504",
        "11514", "11594", " 3911", " 4210", " 4211", " 4219", "42490", "42491", "42499")),
    "chf": CodeRule(exact=(
        "39891", "40201", "40291", "40491", "40413", "40493", "4280 ", "4281 ", "42820", "42821",
        "42822", "42823", "42830", "42831", "42832", "42833", "42840", "42841", "42842", "42843",
        "4289 ", "428  ", "4282 ", "4283 ", "4284 ")),
    "afib": CodeRule(prefixes=("4273",)),
    "renal": CodeRule(prefixes=("585",)),
    "liver": CodeRule(prefixes=("571",)),
    "copd": CodeRule(exact=(
        "4660 ", "490  ", "4910 ", "4911 ", "49120", "49121", "4918 ", "4919 ", "4920 ", "4928 ",
        "494  ", "4940 ", "4941 ", "496  ")),
    "cad": CodeRule(prefixes=("414",)),
    "stroke": CodeRule(prefixes=("430", "431", "432", "433", "434")),
    "malignancy": CodeRule(ranges=(("140", "239"),)),
    "respfail": CodeRule(prefixes=("518",)),
    "ards": CodeRule(exact=("51882", "5185 ")),
    "pneumonia": CodeRule(ranges=(
        ("486", "48881"), ("480", "48099"), ("482", "48299"), ("506", "5078"))),
}

# Severe sepsis by the published Angus criteria (2001), as code prefixes.
SEPSIS = SepsisRule(
    infection=CodeRule(prefixes=(
        "001", "002", "003", "004", "005", "008", "009", "010", "011", "012", "013", "014", "015",
        "016", "017", "018", "020", "021", "022", "023", "024", "025", "026", "027", "030", "031",
        "032", "033", "034", "035", "036", "037", "038", "039", "040", "041", "090", "091", "092",
        "093", "094", "095", "096", "097", "098", "100", "101", "102", "103", "104", "110", "111",
        "112", "114", "115", "116", "117", "118", "320", "322", "324", "325", "420", "421", "451",
        "461", "462", "463", "464", "465", "481", "482", "485", "486", "494", "510", "513", "540",
        "541", "542", "566", "567", "590", "597", "601", "614", "615", "616", "681", "682", "683",
        "686", "730", "5695", "5720", "5721", "5750", "5990", "7110", "7907", "9966", "9985",
        "9993", "49121", "56201", "56203", "56211", "56213", "56983")),
    organ_dysfunction=CodeRule(prefixes=(
        "458", "293", "570", "584", "7855", "3483", "3481", "2874", "2875", "2869", "2866",
        "5734")),
    explicit_sepsis=CodeRule(prefixes=("99592", "78552")),
    mech_vent=CodeRule(prefixes=("9670", "9671", "9672")),
)


@dataclass(frozen=True)
class Concepts:
    """One set of item ids and code rules for the whole study."""

    arterial_line: tuple[int, ...] = ARTERIAL_LINE
    mean_pressure: tuple[int, ...] = MEAN_PRESSURE
    vitals: dict[int, Item] = field(default_factory=lambda: VITALS)
    labs: dict[int, Item] = field(default_factory=lambda: LABS)
    lab_panel: dict[int, Item] = field(default_factory=lambda: LAB_PANEL)
    gas: dict[int, Item] = field(default_factory=lambda: GAS)
    fio2: dict[int, Item] = field(default_factory=lambda: CHARTED_FIO2)
    organ_labs: dict[int, Item] = field(default_factory=lambda: ORGAN_LABS)
    urine: tuple[int, ...] = URINE
    gcs_motor: tuple[int, ...] = GCS_MOTOR
    gcs_verbal: tuple[int, ...] = GCS_VERBAL
    gcs_eyes: tuple[int, ...] = GCS_EYES
    weight_admit: dict[int, Item] = field(default_factory=lambda: WEIGHT_ADMIT)
    weight_daily: dict[int, Item] = field(default_factory=lambda: WEIGHT_DAILY)
    height: dict[int, Item] = field(default_factory=lambda: HEIGHT)
    vasopressor_points: tuple[int, ...] = VASOPRESSOR_POINTS
    vasopressor_intervals: tuple[int, ...] = VASOPRESSOR_INTERVALS
    anaesthetic_points: tuple[int, ...] = ANAESTHETIC_POINTS
    anaesthetic_intervals: tuple[int, ...] = ANAESTHETIC_INTERVALS
    red_cell_points: dict[str, list[int]] = field(default_factory=lambda: RED_CELL_POINTS)
    red_cell_intervals: dict[str, list[int]] = field(default_factory=lambda: RED_CELL_INTERVALS)
    code_status_items: tuple[int, ...] = CODE_STATUS_ITEMS
    code_status: dict[str, str] = field(default_factory=lambda: CODE_STATUS)
    comorbidities: dict[str, CodeRule] = field(default_factory=lambda: COMORBIDITIES)
    sepsis: SepsisRule = SEPSIS
