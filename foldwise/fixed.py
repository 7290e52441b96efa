"""Fixed values.

Names, lists and constants that must hold exactly these values for results to
be right on tables of the supported shape. Nothing here is computed.
"""

# Column families -------------------------------------------------
TECH_CORE = ("coding_score", "problem_solving_score", "data_structures_score", "sql_score")
ENGINEERING = ("backend_score", "frontend_score", "cloud_score", "devops_score")
INTERVIEW = ("technical_interview_score", "hr_interview_score", "communication_score",
             "presentation_score")
SOFT = ("communication_score", "teamwork_score", "leadership_score", "presentation_score")
DATA_ML = ("sql_score", "machine_learning_score")
ALL_TECH = TECH_CORE + ENGINEERING + ("machine_learning_score",)

CATEGORIES = ("department", "university_tier", "target_role")
NOISE_CATEGORIES = ("hobby", "preferred_social_media_platform")
TIER_ORDER = {"Tier 1": 1, "Tier 2": 2, "Tier 3": 3, "Tier 4": 4}
NULL_BEARING = ("english_exam_score", "internship_duration_months", "portfolio_score",
                "github_avg_stars", "open_source_contribution_count",
                "linkedin_profile_score", "hr_interview_score")

ROLE_SKILLS = {
    "Backend Developer": ("backend_score", "sql_score", "data_structures_score"),
    "Frontend Developer": ("frontend_score", "coding_score"),
    "Software Developer": ("coding_score", "data_structures_score", "problem_solving_score"),
    "Data Scientist": ("machine_learning_score", "sql_score", "problem_solving_score"),
    "Data Analyst": ("sql_score", "problem_solving_score"),
    "Cloud Engineer": ("cloud_score", "devops_score"),
    "AI Engineer": ("machine_learning_score", "coding_score"),
    "DevOps Engineer": ("devops_score", "cloud_score"),
    "Cybersecurity Analyst": ("problem_solving_score", "sql_score"),
    "MLOps Engineer": ("machine_learning_score", "devops_score", "cloud_score"),
    "Product Analyst": ("sql_score", "communication_score", "problem_solving_score"),
}

# Z-score parts (raw columns, then log1p columns) -----------------
Z_RAW = ("portfolio_score", "linkedin_profile_score", "cv_quality_score",
         "project_quality_score", "internship_duration_months", "github_avg_stars")
Z_LOG = ("github_repo_count", "open_source_contribution_count", "freelance_project_count",
         "internship_count", "real_client_project_count")
Z_EPS = 1e-9
PORTFOLIO_Z = (("portfolio_score", False), ("linkedin_profile_score", False),
               ("cv_quality_score", False), ("github_repo_count", True),
               ("github_avg_stars", False), ("open_source_contribution_count", True))
EXPERIENCE_Z = (("internship_count", True), ("internship_duration_months", False),
                ("freelance_project_count", True), ("project_quality_score", False),
                ("real_client_project_count", True))
ROLE_RELATIVE = ("technical_strength", "engineering_strength", "project_quality_score",
                 "technical_interview_score", "role_skill_match")

# Folds, weights, smoothing ---------------------------------------
SEED = 42
REPEAT_SEEDS = (42, 2025, 7)
N_FOLDS = 5
INNER_SPLITS = 4
INNER_SEED_STEP = 31
FOLD_SEED_STEP = 7
REFEREE_SEED_STEP = 101
TARGET_BINS = 20
TARGET_BINS_BY_YEAR = 10
WEIGHT_CLIP = (0.25, 3.0)
TE_SMOOTHING = 20.0
TE_COLUMNS = ("target_role", "department", "university_tier", "application_year")
NULL_LEVEL = "nan"
CEILING = 100.0
CLIP = (0.0, 100.0)
AUTO_TOP_N = 8
STANDARD_EPS = 1e-6
STANDARD_CLAMP = 8.0
KNN_IMPUTE_K = 10
KNN_TEXT_K = 32
RIDGE_STACK_ALPHAS = (-3.0, 4.0, 29)      # log10 from, log10 to, points
TFIDF_RIDGE_ALPHA = 2.0
EMBED_RIDGE_ALPHA = 1.0
SVD_DIMS = 24
PCA_DIMS = 32

# Vocabularies ----------------------------------------------------
WORD_GRAMS = (1, 3)
WORD_MAX_FEATURES = 5000
WORD_MIN_DF = 2
CHAR_GRAMS = (3, 5)
CHAR_MAX_FEATURES = 30000
CHAR_MIN_DF = 3
PROFILE_GRAMS = (1, 2)
PROFILE_MAX_FEATURES = 20000
PROFILE_TERMS = 15

# Word lists (Turkish) --------------------------------------------
POSITIVE = ("güçlü", "dikkat çekici", "etkileyici", "başarılı", "umut verici",
            "yüksek", "mükemmel", "üstün", "yetkin", "uzman", "olumlu",
            "parlak", "sağlam", "potansiyel", "ileri düzey", "takdir")
NEGATIVE = ("geliştirmesi", "gelişim göster", "eksik", "zayıf", "yetersiz",
            "düşük", "ihtiyaç", "daha fazla", "çalışması gerek", "odaklanmalı",
            "geride", "sınırlı")
CONTRAST = ("ancak", "fakat", "ama ", "buna rağmen", "öte yandan")
CONTRAST_MARKERS = ("ancak", "fakat", "bununla birlikte", "buna rağmen", "öte yandan", "ama ")
MENTIONS = {
    "kodlama": "coding", "yazılım": "coding", "problem çözme": "probsolve",
    "analitik": "probsolve", "veri yapıları": "datastruct", "sql": "sql",
    "veritabanı": "sql", "makine öğren": "ml", "yapay zeka": "ml",
    "veri bilimi": "ml", "backend": "backend", "frontend": "frontend",
    "bulut": "cloud", "cloud": "cloud", "devops": "devops",
    "iletişim": "comm", "takım": "team", "ekip": "team", "işbirliği": "team",
    "liderlik": "lead", "sunum": "present", "proje kalite": "projq",
    "proje": "proj", "portföy": "portfolio", "github": "portfolio",
    "staj": "intern", "müşteri": "client", "teknik görüşme": "techint",
    "görüşme": "interview", "ingilizce": "english", "sertifika": "cert",
    "hackathon": "hack",
}

# Importance prior of the analysis brief --------------------------
PRIOR = {
    "project_quality_score": 0.80, "technical_interview_score": 0.45,
    "problem_solving_score": 0.22, "communication_score": 0.18, "cloud_score": 0.17,
    "devops_score": 0.15, "github_repo_count": 0.14, "portfolio_score": 0.12,
    "backend_score": 0.11, "coding_score": 0.10, "real_client_project_count": 0.09,
    "open_source_contribution_count": 0.09, "frontend_score": 0.08,
    "data_structures_score": 0.07, "application_year": 0.06, "sql_score": 0.06,
    "github_avg_stars": 0.05, "graduation_year": 0.04, "target_role": 0.04,
    "machine_learning_score": 0.03, "cv_quality_score": 0.02,
    "linkedin_profile_score": 0.02, "teamwork_score": 0.02,
    "freelance_project_count": 0.01, "cgpa": 0.01,
}
PRIOR_INTERACTIONS = ("project_quality_score", "technical_interview_score",
                      "problem_solving_score", "communication_score", "cloud_score",
                      "devops_score", "github_repo_count", "portfolio_score",
                      "backend_score", "coding_score", "real_client_project_count",
                      "open_source_contribution_count")

# Search limits by profile and learner (fixed values): trials, seconds.
SEARCH_LIMITS = {
    "full": {"boosted": (51, 4200.0), "forest": (200, 2100.0), "ridge": (200, 1800.0), "factor": (30, 2400.0)},
    "fullw": {"boosted": (150, 5400.0), "forest": (60, 1500.0), "ridge": (120, 1500.0), "factor": (25, 1500.0)},
    "fast": {"boosted": (40, 1200.0), "forest": (30, 600.0), "ridge": (40, 500.0), "factor": (10, 700.0)},
    "smoke": {"boosted": (2, 240.0), "forest": (2, 240.0), "ridge": (2, 240.0), "factor": (2, 240.0)},
}
