"""Column names, sentinels and other values fixed by the input formats."""

from __future__ import annotations

# The missing-number cell of bioactivity exports, and the columns it occurs in.
MISSING_NUMBER = " -  "
NUMBER_COLUMNS = [
    "CONTINUOUS_HIT_CALL", "TOP", "SCALED_TOP", "AC50", "LOGAC50", "CUTOFF", "ACC", "AC10", "BMR", "BMD", "BMAD",
    "MAX_MED_CONC", "STOCK_CONC", "CYTOTOX_BURST",
]

# The bioactivity table, in insert order.
BIOACTIVITY_COLUMNS = [
    "TITLE", "DTXSID", "NAME", "ASSAY_ENDPOINT_DESCRIPTION", "ASSAY_COMPONENT_NAME", "ASSAY_COMPONENT_DESCRIPTION",
    "DESCRIPTION", "SEQAPASS", "GENE_SYMBOL", "GENE_URL", "GENE_NAME", "AOP", "EVENT", "HIT_CALL",
    "CONTINUOUS_HIT_CALL", "TOP", "SCALED_TOP", "AC50", "LOGAC50", "CUTOFF", "ACC", "AC10", "BMR", "BMD", "BMAD",
    "MAX_MED_CONC", "NORMALIZED_DATA_TYPE", "ASSAY_SOURCE", "ASSAY_NAME", "ASSAY_DESC", "ASSAY_FUNCTION_TYPE",
    "FLAGS", "STOCK_CONC", "STOCK_CONC_UNITS", "ORGANISM", "CELL_LINE", "CELL_FORMAT", "CONCENTRATION", "RESPONSE",
    "CYTOTOX_BURST", "INTENDED_TARGET_FAMILY", "INTENDED_TARGET_TYPE", "INTENDED_TARGET_TYPE_SUB",
    "INTENDED_TARGET_FAMILY_SUB", "BIOLOGICAL_PROCESS_TARGET", "DETECTION_TECHNOLOGY_TYPE", "TISSUE", "SAMPLE_ID",
    "REPR",
]
SHEET_COLUMNS = [c for c in BIOACTIVITY_COLUMNS if c not in ("TITLE", "DTXSID")]

# Node property -> source column.
AOP_PROPS = {
    "title": "Title", "contact": "Point of Contact", "license": "License", "mie": "MIE", "ao": "AO",
    "status": "OECD Status", "project": "OECD Project",
}
EVENT_LEVEL_PROPS = {"title": "Title", "level": "Biological organization"}
EVENT_PROPS = {
    "title": "Title", "biological_organization": "Biological organization", "creation_date": "Creation Date",
    "last_updated": "Last Updated", "AOPs": "AOPs",
}
RELATION_PROPS = {
    "upstream_event": "Upstream Event", "downstream_event": "Downstream Event", "last_updated": "Last Updated",
    "creation_date": "Creation Date", "AOPs": "AOPs",
}
STRESSOR_PROPS = {"name": "Prototypical Stressor Name", "chemical": "Associated Chemical(s): Name, CAS-RN, DTXSID"}
CHEMICAL_PROPS = {
    "name": "PREFERRED NAME", "casrn": "CASRN", "inchikey": "INCHIKEY", "iupac": "IUPAC NAME", "smiles": "SMILES",
    "inchi": "INCHI STRING", "formula": "MOLECULAR FORMULA", "avg_mass": "AVERAGE MASS", "mass": "MONOISOTOPIC MASS",
    "qc_level": "QC Level", "n_active": "# ToxCast Active", "n_total": "Total Assays",
    "pct_active": "% ToxCast Active",
}
CHEMICAL_TYPES = {"avg_mass": "double", "mass": "double", "n_active": "bigint", "n_total": "bigint", "pct_active": "double"}
ASSAY_CHEMICAL_PROPS = {
    "name": "PREFERRED NAME", "casrn": "CASRN", "formula": "MOLECULAR FORMULA", "mass": "MONOISOTOPIC MASS",
}
RESULT_PROPS = {"hitc": "HIT CALL", "ac50": "AC50", "logac50": "LOGAC50", "top": "TOP", "scaled_top": "SCALED TOP"}
RESULT_TYPES = {"ac50": "double", "logac50": "double", "top": "double", "scaled_top": "double"}

# File-name parts of the exports.
ASSAY_PREFIX = "Assay List "
CHEMICAL_PREFIX = "Chemical List "
DATED_SUFFIX = r"-\d{4}-\d{2}-\d{2}\.xlsx$"
SUMMARY_SUFFIX = r" Toxcast Summary -\d{4}-\d{2}-\d{2}\.(?:xlsx|zip)"
SUMMARY_MARK = " Toxcast Summary"

# Fixed value: text of a detail page that has no record behind it.
ABSENT_MARK = "This event does not exist."

# Cell texts that the pandas readers take as missing by default.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The characters Python's str.strip() removes.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0            "
    "    　"
)
