"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the catalogue's
own vocabulary for results to match: label dictionaries, name lists, override
tables and rule constants. They are stated here once, in natural order, and
turned into columns / small DataFrames by the operators. The long dormant
dictionaries (ammo round class / calibre / efficiency, loot names: 176-216
entries) are not restated; pass them as parameter tables (``read_lookup``).
"""

# ---- FIXED VALUES: armour / rig protected zones -> Korean (I1, drop unknown)
ARMOR_ZONES_KR = {
    "F. PLATE": "앞쪽 방탄판",
    "FR. PLATE": "앞쪽 방탄판",
    "BCK. PLATE": "뒤쪽 방탄판",
    "L. PLATE": "왼쪽 방탄판",
    "R. PLATE": "오른쪽 방탄판",
    "Thorax": "흉부",
    "Thorax, Upper back": "흉부 - 위쪽 등",
    "Stomach": "복부",
    "Stomach, Lower back": "복부 - 아래쪽 등",
    "Stomach, Left Side": "복부 - 왼쪽 옆구리",
    "Stomach, Right Side": "복부 - 오른쪽 옆구리",
    "Stomach, Groin": "복부 - 골반",
    "Stomach, Buttocks": "복부 - 엉덩이",
    "Head, Throat": "머리 - 목 앞쪽",
    "Head, Neck": "머리 - 목 뒤쪽",
    "Left arm, Shoulder": "왼팔 - 어깨",
    "Right arm, Shoulder": "오른팔 - 어깨",
}

# ---- FIXED VALUES: head zones -> Korean (I2, default for unknown; after I4)
HEAD_ZONES_KR = {
    "Head, Top of the head": "윗머리",
    "Head, Nape": "뒷머리",
    "Head, Ears": "귀",
    "Head, Face": "얼굴",
    "Head, Eyes": "눈",
    "Head, Jaws": "턱",
    "Head, Throat": "목 앞쪽",
    "Head, Back Neck": "목 뒤쪽",
}
HEAD_ZONE_UNKNOWN_KR = "알 수 없는 부위"
# I4: one zone renamed before labelling
HEAD_ZONE_RENAME = ("Head, Neck", "Head, Back Neck")

# ---- FIXED VALUES: cures -> Korean (I1, drop unknown)
CURES_KR = {
    "Pain": "고통 제거",
    "Contusion": "뇌진탕 제거",
    "LightBleeding": "가벼운 출혈 제거",
    "HeavyBleeding": "깊은 출혈 제거",
    "Fracture": "골절 제거",
}

# ---- FIXED VALUES: map name -> map codes (L10, default ["N/A"])
MAP_CODES = {
    "Factory": ["FACTORY"],
    "Customs": ["CUSTOMS"],
    "Woods": ["WOODS"],
    "Lighthouse": ["LIGHT_HOUSE"],
    "Shoreline": ["SHORELINE"],
    "Reserve": ["RESERVE"],
    "Interchange": ["INTERCHANGE"],
    "Streets of Tarkov": ["STREET_OF_TARKOV"],
    "Night Factory": ["FACTORY"],
    "The Lab": ["THE_LAB"],
    "Ground Zero": ["GROUND_ZERO"],
    "Ground Zero 21+": ["GROUND_ZERO"],
}
MAP_CODES_DEFAULT = ["N/A"]

# ---- FIXED VALUES: key name -> map codes, fixed before any lookup
KEY_MAP_OVERRIDE = {
    "Factory emergency exit key": ["FACTORY", "CUSTOMS", "INTERCHANGE", "SHORELINE"],
    "USEC cottage second safe key": ["LIGHT_HOUSE", "STREET_OF_TARKOV"],
    "Pinewood hotel room 206 key": ["STREET_OF_TARKOV"],
    "Weather station safe key": ["SHORELINE"],
    "Gas station safe key": ["SHORELINE"],
    "Goshan cash register key": ["INTERCHANGE"],
}
# Name-contains rules after the fixed list, in order
KEY_MAP_CONTAINS = [("Health Resort", ["SHORELINE"]), ("TerraGroup Labs", ["THE_LAB"])]

# ---- FIXED VALUES: map code -> English / Korean (I3, pass unknown through)
MAP_CODE_EN = {
    "FACTORY": "Factory",
    "CUSTOMS": "Customs",
    "WOODS": "Woods",
    "LIGHT_HOUSE": "Lighthouse",
    "SHORELINE": "Shoreline",
    "RESERVE": "Reserve",
    "INTERCHANGE": "Interchange",
    "STREET_OF_TARKOV": "Streets of Tarkov",
    "THE_LAB": "The Lab",
    "GROUND_ZERO": "Ground Zero",
}
MAP_CODE_KR = {
    "FACTORY": "팩토리",
    "CUSTOMS": "세관",
    "WOODS": "삼림",
    "LIGHT_HOUSE": "등대",
    "SHORELINE": "해안선",
    "RESERVE": "리저브",
    "INTERCHANGE": "인터체인지",
    "STREET_OF_TARKOV": "타르코프 시내",
    "THE_LAB": "연구소",
    "GROUND_ZERO": "그라운드 제로",
}

# ---- FIXED VALUES: fire mode substrings -> Korean, all rules tested
FIRE_MODES_KR = [
    ("Single fire", "단발"),
    ("Full auto", "자동"),
    ("Burst Fire", "점사"),
    ("Double-Tap", "더블 탭"),
    ("Double action", "더블 액션"),
    ("Semi-auto", "반자동"),
]

# ---- FIXED VALUES: weapon short-name override by full name
WEAPON_SHORT_NAME = {
    "FN SCAR-L 5.56x45 assault rifle": "FN SCAR-L",
    "FN SCAR-L 5.56x45 assault rifle (FDE)": "FN SCAR-L FDE",
    "FN SCAR-H 7.62x51 assault rifle": "FN SCAR-H",
    "FN SCAR-H 7.62x51 assault rifle (FDE)": "FN SCAR-H FDE",
    "SWORD International Mk-18 .338 LM marksman rifle": "Mk-18",
}

# ---- FIXED VALUES: weapon recategorisation, first match wins
WEAPON_SPECIAL = ["SP-81", "Green", "Red", "Flare", "Yellow"]
WEAPON_GRENADE = ["MSGL"]
WEAPON_SHOTGUN = "MTs-255-12"
WEAPON_REVOLVER_CATEGORY = "Revolver"
WEAPON_CARBINE = ["ADAR 2-15", "TX-15 DML", 'VPO-136 "Vepr-KM"', "VPO-209",
                  "AK-545", "AK-545 Short", "RFB"]
WEAPON_RIFLE = ["AS VAL"]

# ---- FIXED VALUES: weapon image lookup (D9): constant override, strip lengths
WEAPON_IMAGE_OVERRIDE = {
    "Desert Tech MDR 5.56x45 assault rifle":
        "https://assets.tarkov.dev/5c98bd7386f7740cfb15654e-512.webp",
}
WEAPON_IMAGE_STRIP = [8, 7, 6]

# ---- FIXED VALUES: loot recategorisation, first match wins
LOOT_SPECIAL_CATEGORIES = ["Portable Range Finder", "Radio Transmitter", "Repair Kits",
                           "Compass", "Cultist Amulet"]
LOOT_JEWELRY = ["Battered antique book", "Loot Lord plushie", "Old firesteel"]
LOOT_LUBRICANT = ['Gunpowder "Eagle"', 'Gunpowder "Hawk"', 'Gunpowder "Kite"',
                  "Metal fuel tank", "Expeditionary fuel tank"]

# ---- FIXED VALUES: category routing constants
GUN_IMAGE_NAME_PARTS = ["Default", "Lobaev Arms DVL-10 7.62x51 bolt-action sniper rifle Urbana",
                        "Colt M4A1 5.56x45 assault rifle Carbine",
                        "Kalashnikov PKP 7.62x54R infantry machine gun Zenit"]
HEADWEAR_EXCLUDED = ["Maska-1SCh bulletproof helmet (Killa Edition) Default",
                     "Ops-Core FAST MT Super High Cut helmet (Black) RAC",
                     "Wilcox Skull Lock head mount PVS-14"]
LOOT_PARENTS = ["Barter item", "Special item", "Lubricant"]
LOOT_CATEGORY = "Info"
LOOT_EXCLUDED = ["Dogtag BEAR", "Dogtag USEC", "Decrypted flash drive",
                 "Documents with decrypted data", "Encrypted flash drive"]
LOOT_EXCLUDED_PART = "Locked"

# ---- FIXED VALUES: ricochet
RICOCHET_OVERRIDE = {
    "Team Wendy EXFIL Ballistic Helmet (Black)": 0.4,
    "Team Wendy EXFIL Ballistic Helmet (Coyote Brown)": 0.4,
    "DevTac Ronin ballistic helmet": 0.4,
}
RICOCHET_BOUNDS = [0.2, 0.4]
RICOCHET_EN = ["Low", "Medium", "High"]
RICOCHET_KR = ["낮음", "중간", "높음"]

# ---- FIXED VALUES: medical effect labels (I6, medical vocabulary)
MED_SKILL_KR = {
    "Intellect": "지력",
    "Attention": "주의력",
    "Recoil Control": "반동 제어",
    "Stress Resistance": "스트레스 저항력",
    "Endurance": "지구력",
    "Mag Drills": "탄창 훈련",
    "Strength": "근력",
    "Metabolism": "신진대사",
    "Memory": "기억력",
    "Health": "체력",
    "Vitality": "활력",
    "Immunity": "면역력",
    "Perception": "인지능력",
    "Charisma": "카리스마",
}
MED_TYPE_KR = {
    "Antidote": "해독제",
    "Body temperature": "체온",
    "Damage taken (except the head)": "받은 피해량 (머리 제외)",
    "energyImpact": "에너지",
    "hydrationImpact": "수분",
    "Max stamina": "최대 스태미나",
    "Pain": "고통",
    "Stamina recovery": "스태미나 회복",
    "Stops and prevents bleedings": "출혈 멈춤 & 추가 출혈 방지",
    "Tunnel effect": "터널 효과",
    "Weight limit": "무게 제한",
    "painkillerDuration": "진통제",
    "Energy recovery": "에너지 회복",
    "Health regeneration": "체력 재생",
    "Hands tremor": "손 떨림",
    "Hydration recovery": "수분 회복",
}

# ---- FIXED VALUES: provisions effect labels (I6, provisions vocabulary)
FOOD_SKILL_KR = {
    "Intellect": "지력",
    "Attention": "주의력",
    "Stress Resistance": "스트레스 저항력",
    "Endurance": "지구력",
    "Mag Drills": "탄창 훈련",
    "Strength": "근력",
    "Metabolism": "신진대사",
    "Memory": "기억력",
    "Health": "체력",
    "Vitality": "활력",
    "Immunity": "면역력",
    "Perception": "인지능력",
    "Charisma": "카리스마",
}
FOOD_TYPE_KR = {
    "Energy recovery": "에너지 회복",
    "Health regeneration": "체력 재생",
    "Hands tremor": "손 떨림",
    "Hydration recovery": "수분 회복",
}

# ---- FIXED VALUES: buff / debuff rules
ALWAYS_BUFF = ["Antidote", "Stops and prevents bleedings"]
ALWAYS_DEBUFF = ["Hands tremor", "Pain", "Tunnel effect"]
SIGNED_TYPES = ["Energy recovery", "Health regeneration", "Hydration recovery", "Max stamina",
                "Stamina recovery", "Weight limit", "energyImpact", "hydrationImpact"]
INVERTED_TYPE = "Body temperature"      # value < 0 is a buff, > 0 a debuff
DURATION_TYPE = "painkillerDuration"    # sign of duration decides
SIGNED_SKILLS = ["Health", "Strength", "Vitality", "Metabolism", "Endurance", "Recoil Control",
                 "Stress Resistance", "Perception", "Immunity", "Attention", "Intellect",
                 "Charisma"]

# ---- FIXED VALUES: painkiller effects appended by product name
# injectors: (name, duration); delay 0, value 0, chance 1, type painkillerDuration
INJECTOR_PAINKILLER = [
    ("L1 (Norepinephrine) injector", 120),
    ("Trimadol stimulant injector", 185),
    ("Adrenaline injector", 65),
    ("Propital regenerative stimulant injector", 245),
]
# drinks: (name, duration); type Skill, delay 1, value 1, skillName Painkiller, krSkill 진통제
DRINK_PAINKILLER = [
    ("Bottle of Dan Jackiel whiskey", 210),
    ("Bottle of Tarkovskaya vodka", 250),
    ("Bottle of Fierce Hatchling moonshine", 500),
]
DRINK_PAINKILLER_KR = "진통제"

# ---- FIXED VALUES: painkiller duration override by name
PAINKILLER_DURATION = {
    "Analgin painkillers": 95,
    "Augmentin antibiotic pills": 155,
    "Ibuprofen painkillers": 290,
    "Vaseline balm": 350,
    "Golden Star balm": 370,
    "Morphine injector": 305,
}

# ---- FIXED VALUES: reclassified product (I8)
RECLASSIFIED_NAME = "Morphine injector"
RECLASSIFIED_CATEGORY = "Stimulant"
RECLASSIFIED_DROPPED = ["cures", "useTime", "uses", "energyImpact", "hydrationImpact",
                        "painkillerDuration"]
# (duration, type, value); delay 0, chance 1, skillName NULL
RECLASSIFIED_EFFECTS = [(305, "painkillerDuration", 0.0), (0, "energyImpact", -10.0),
                        (0, "hydrationImpact", -15.0)]

# ---- FIXED VALUES: constants of the community jobs
LIKE_BOUND = 10                 # C6
QUEST_ITEM_CATEGORY = "Quest items"  # P27
