"""Domain constants: sensor tags, event names and class codes.

Fixed values: they have to equal the recorded data set for results to be right.
"""

from __future__ import annotations

# Fixed values: (tag, name, unit) of every column of the observation table.
TAGS = [
    ("ABER-CKGL", "Opening of the GLCK (gas lift choke)", "%"),
    ("ABER-CKP", "Opening of the PCK (production choke)", "%"),
    ("ESTADO-DHSV", "State of the DHSV (downhole safety valve)", "[0, 0.5, 1]"),
    ("ESTADO-M1", "State of the PMV (production master valve)", "[0, 0.5, 1]"),
    ("ESTADO-M2", "State of the AMV (annulus master valve)", "[0, 0.5, 1]"),
    ("ESTADO-PXO", "State of the PXO (pig-crossover) valve", "[0, 0.5, 1]"),
    ("ESTADO-SDV-GL", "State of the gas lift SDV (shutdown valve)", "[0, 0.5, 1]"),
    ("ESTADO-SDV-P", "State of the production SDV (shutdown valve)", "[0, 0.5, 1]"),
    ("ESTADO-W1", "State of the PWV (production wing valve)", "[0, 0.5, 1]"),
    ("ESTADO-W2", "State of the AWV (annulus wing valve)", "[0, 0.5, 1]"),
    ("ESTADO-XO", "State of the XO (crossover) valve", "[0, 0.5, 1]"),
    ("P-ANULAR", "Pressure in the well annulus", "Pa"),
    ("P-JUS-BS", "Downstream pressure of the SP (service pump)", "Pa"),
    ("P-JUS-CKGL", "Downstream pressure of the GLCK (gas lift choke)", "Pa"),
    ("P-JUS-CKP", "Downstream pressure of the PCK (production choke)", "Pa"),
    ("P-MON-CKGL", "Upstream pressure of the GLCK (gas lift choke)", "Pa"),
    ("P-MON-CKP", "Upstream pressure of the PCK (production choke)", "Pa"),
    ("P-MON-SDV-P", "Upstream pressure of the production SDV (shutdown valve)", "Pa"),
    ("P-PDG", "Pressure at the PDG (permanent downhole gauge)", "Pa"),
    ("PT-P", "Downstream pressure of the PWV in the production tube", "Pa"),
    ("P-TPT", "Pressure at the TPT (temperature and pressure transducer)", "Pa"),
    ("QBS", "Flow rate at the SP (service pump)", "m3/s"),
    ("QGL", "Gas lift flow rate", "m3/s"),
    ("T-JUS-CKP", "Downstream temperature of the PCK (production choke)", "°C"),
    ("T-MON-CKP", "Upstream temperature of the PCK (production choke)", "°C"),
    ("T-PDG", "Temperature at the PDG (permanent downhole gauge)", "°C"),
    ("T-TPT", "Temperature at the TPT (temperature and pressure transducer)", "°C"),
    ("class", "Label of the observation", "Label"),
    ("state", "Well operational status", "Operational Status"),
    ("label", "Instance label (event type)", "Instance Label"),
    ("well", "Well name", "Well Name"),
    ("id", "Instance identifier", "Instance ID"),
    ("Instance", "Instance count based on manual labeling", "Instance ID (Manual)"),
    ("DataType", "Real , simulated or hand-drawn", "Dataset Type"),
    ("timestamp", "Timestamp", "Timestamp"),
]

# Event type of an instance label.
EVENTS = [
    (0, "NORMAL"),
    (1, "ABRUPT INCREASE OF BSW"),
    (2, "SPURIOUS CLOSURE OF DHSV"),
    (3, "SEVERE SLUGGING"),
    (4, "FLOW INSTABILITY"),
    (5, "RAPID PRODUCTIVITY LOSS"),
    (6, "QUICK RESTRICTION IN PCK"),
    (7, "SCALING IN PCK"),
    (8, "HYDRATE IN PRODUCTION LINE"),
    (9, "HYDRATE IN SERVICE LINE"),
]

# Columns of the observation table that carry no data in any source.
EMPTY_TAGS = ["P-JUS-BS", "P-MON-SDV-P", "PT-P", "QBS"]
# Class codes.  A transient phase is coded 100 + label.
TRANSIENT_LABELS = [1, 2, 5, 6, 7, 8, 9]
EVENT_CLASSES = [3, 4, 101, 102, 105, 106, 107, 108, 109]
EVENT_LABELS = [1, 2, 3, 4, 5, 6, 7, 8, 9]
# Columns that are never model inputs.
NON_FEATURES = ["Instance", "label", "timestamp", "class", "target", "state", "well", "id",
                "DataType"]
# The order in which the three sources are numbered.
SOURCES = ["Real", "Simulated", "Drawn"]

CATEGORICAL_TAGS = [t for t, _, _ in TAGS if t.startswith("ESTADO-")]
CONTINUOUS_TAGS = [
    t for t, _, u in TAGS
    if u in ("%", "Pa", "m3/s", "°C") and t not in EMPTY_TAGS
]
SENSOR_TAGS = [t for t, _, _ in TAGS if t in CATEGORICAL_TAGS or t in CONTINUOUS_TAGS]
