"""Lookup tables. They have to equal what existing corpora were built with."""

PUBLICATION_TYPES = {
    "practice guideline": "practice_guideline",
    "meta-analysis": "meta_analysis",
    "systematic review": "systematic_review",
    "randomized controlled trial": "randomized_controlled_trial",
    "clinical trial, phase iii": "clinical_trial_phase_iii",
    "clinical trial, phase ii": "clinical_trial_phase_ii",
    "clinical trial, phase iv": "clinical_trial_phase_iv",
    "clinical trial, phase i": "clinical_trial_phase_i",
    "controlled clinical trial": "controlled_clinical_trial",
    "clinical trial": "clinical_trial",
    "multicenter study": "multicenter_study",
    "review": "review",
}

EVIDENCE_TERMS = [
    ("meta-analysis", "A"), ("systematic-review", "A"), ("systematic review", "A"), ("practice-guideline", "A"), ("guideline", "A"),
    ("randomized-controlled-trial", "A"), ("randomized controlled trial", "A"), ("clinical-trial", "A"), ("clinical trial", "A"),
    ("cohort-study", "B"), ("cohort study", "B"), ("review", "B"), ("case-control", "B"), ("cross-sectional", "B"),
    ("case-report", "C"), ("case report", "C"), ("case-series", "C"), ("editorial", "D"), ("letter", "D"), ("comment", "D"),
]

EVIDENCE_LEVELS = {"A": 1, "B": 2, "C": 3, "D": 4}

SECTION_TYPES = {
    "intro": "introduction", "introduction": "introduction", "methods": "methods", "materials": "methods", "materials|methods": "methods",
    "methodology": "methods", "results": "results", "disc": "discussion", "discussion": "discussion", "concl": "conclusions",
    "conclusions": "conclusions", "conclusion": "conclusions", "case-report": "case_report", "case-study": "case_report",
    "ack": "acknowledgments", "acknowledgments": "acknowledgments", "abstract": "abstract_text",
}

#: Where the type says nothing: part of the title, in order of precedence.
TITLE_HINTS = [("method", "methods"), ("result", "results"), ("discuss", "discussion"), ("conclusion", "conclusions"), ("intro", "introduction"), ("case", "case_report")]

SECTION_WEIGHTS = {
    "abstract": 1.0, "abstract_text": 1.0, "title": 1.0, "introduction": 0.7, "methods": 0.6, "results": 0.9, "discussion": 0.8, "conclusions": 0.85,
    "conclusion": 0.85, "case_report": 0.8, "table": 0.75, "figure": 0.6, "references": 0.1, "acknowledgments": 0.1, "funding": 0.1, "body": 0.5, "other": 0.5,
}

LABEL_SECTIONS = {
    "34066-3": ("highlights", "Highlights of Prescribing Information"), "34067-9": ("indications", "Indications & Usage"),
    "34068-7": ("dosage", "Dosage & Administration"), "34070-3": ("contraindications", "Contraindications"), "34071-1": ("warnings", "Warnings"),
    "43685-7": ("warnings", "Warnings & Precautions"), "34084-4": ("adverse_reactions", "Adverse Reactions"), "34073-7": ("interactions", "Drug Interactions"),
    "34066-1": ("boxed_warning", "Boxed Warning"), "34074-5": ("use_in_specific_populations", "Use in Specific Populations"),
    "43684-0": ("use_in_specific_populations", "Use in Specific Populations"), "34092-7": ("clinical_studies", "Clinical Studies"),
}

LABEL_WEIGHTS = {
    "highlights": 1.0, "boxed_warning": 1.0, "contraindications": 0.95, "warnings": 0.9, "indications": 0.85, "dosage": 0.85,
    "adverse_reactions": 0.8, "interactions": 0.8, "use_in_specific_populations": 0.75, "clinical_studies": 0.7,
}

PRESCRIPTION_CODE = "34391-3"
PRESCRIPTION_TOKEN = "human prescription drug label"

#: Part of an affiliation -> agency; the first that an affiliation phrase contains holds, so the general institute shadows its branches.
AGENCY_PHRASES = [
    ("national institutes of health", "NIH"), ("national institute of", "NIH"), ("nih,", "NIH"), ("(nih)", "NIH"), (" nih ", "NIH"),
    ("centers for disease control", "CDC"), ("cdc,", "CDC"), ("(cdc)", "CDC"), (" cdc ", "CDC"),
    ("food and drug administration", "FDA"), ("fda,", "FDA"), ("(fda)", "FDA"), (" fda ", "FDA"),
    ("veterans affairs", "VA"), ("va medical", "VA"), ("va hospital", "VA"), ("walter reed", "Walter Reed"), ("uniformed services university", "USUHS"),
    ("national library of medicine", "NLM"), ("national cancer institute", "NCI"), ("national heart, lung, and blood", "NHLBI"),
    ("national eye institute", "NEI"), ("national institute on aging", "NIA"), ("national human genome research", "NHGRI"),
    ("agency for healthcare research and quality", "AHRQ"), ("ahrq", "AHRQ"),
]

GRANT_TOKENS = ["nih", "national institutes", "cdc", "fda", "va ", "veterans", "ahrq"]

EXCLUDED_SECTION_TYPES = ["references", "bibliography", "acknowledgments", "funding", "conflict", "disclosure", "author_contributions", "supplementary"]
EXCLUDED_SECTION_TITLES = [
    "references", "bibliography", "literature cited", "acknowledgments", "acknowledgements", "funding", "financial support", "conflict of interest",
    "author contributions", "disclosure", "supplementary data",
]

OPEN_FLAGS = ["is_pmc_openaccess", "is_open_access", "open_access", "openaccess", "is_commercial_license", "commercial_license", "allows_commercial_use"]
LICENSE_FIELDS = ["license", "license_type", "license-name", "license_name", "license_text"]
NON_COMMERCIAL = ["cc-by-nc", "by-nc", "non-commercial", "noncommercial"]
