"""Default vocabulary and thresholds of the transcript operators.

Fixed values: these word lists, replacements, patterns and limits must equal the ones of the
results to be matched. They are defaults; every operator takes them as parameters, so the
same operators serve other languages.
"""

from __future__ import annotations

# --- sources and files
ANCHOR, PRIMARY, SUPPORT = "apple", "qwen", ("nemotron", "whisper")
SOURCES = (ANCHOR, PRIMARY, *SUPPORT)
SOURCE_PRIORITY = ("qwen", "apple", "nemotron", "whisper")
ENGINE_SUFFIX = {"qwen": ".qwen3-asr-1.7b.txt", "nemotron": ".mlx-nemotron-3.5-asr-0.6b.txt", "whisper": ".whisper-small.txt"}
FINAL_JSON_SUFFIX = ".MacOS-SpeechAnalyzer.json"
FALLBACK_TEXT_SUFFIX = ".MacOS-SpeechAnalyzer.txt"
RAW_ZIP_SUFFIX = ".MacOS-SpeechAnalyzer.raw_apple.json.zip"
VOLATILE_ZIP_SUFFIX = ".MacOS-SpeechAnalyzer.raw_volatile_apple.json.zip"
PREFIX_MARKERS = (".MacOS-SpeechAnalyzer", ".mlx-nemotron-3.5-asr-0.6b", ".qwen3-asr-1.7b", ".whisper-small", ".scores", ".stt", ".llm")

# --- segmentation
TERMINATORS = "。！？!?"
DEFAULT_CONFIDENCE = 0.8
MIN_FRAGMENT = 3
BLOCK_MIN_UNITS, BLOCK_MAX_UNITS, BLOCK_MIN_SECONDS, BLOCK_MAX_SECONDS = 2, 5, 8.0, 25.0
SHORT_CHUNK_CHARS, SHORT_CHUNK_SECONDS, MERGED_CHARS, MERGED_SECONDS = 20, 6.0, 120, 25.0

# --- short responses and phrase boundaries
SHORT_RESPONSES = (
    "はい",
    "うん",
    "そうですね",
    "そうなんですよね",
    "そうですよね",
    "なるほど",
    "ありますね",
    "聞いたことないです",
    "聞いたことないですか",
    "いや本当ですね",
    "本当はね",
    "そうなんです",
)
HINT_TYPE, HINT_REASON, HINT_CONFIDENCE = "short_response_period", "possible_speaker_change", 0.85
HINT_APPLIES = ("display_text", "block_boundary", "cleanup_guard")
PHRASE_BOUNDARIES = (
    ("なるほど一体", "なるほど。一体"),
    ("8050問題はい", "8050問題。はい"),
    ("聞いたことないですか8050問題", "聞いたことないですか。8050問題"),
)

# --- terms
TERM_ALIASES = {
    "8050": ("8050", "八〇五〇"),
    "80歳": ("80歳",),
    "50歳": ("50歳",),
    "20歳": ("20歳",),
    "DNA": ("DNA", "ＤＮＡ"),
    "資本主義": ("資本主義",),
    "大家族": ("大家族", "大家族制"),
    "核家族": ("核家族",),
    "子供部屋": ("子供部屋", "子ども部屋"),
    "建築ラボ": ("建築ラボ", "建築LABO", "検知クラボ"),
    "遠藤": ("遠藤",),
    "矢野": ("矢野", "八納", "八野"),
}
CRITICAL_TERMS = ("8050", "80歳", "50歳", "20歳", "DNA", "遠藤", "矢野", "建築ラボ")
SOFT_TERMS = ("資本主義", "大家族", "核家族", "子供部屋", "社会問題", "社会課題", "先進国", "親の家")
SURFACE_SPELLINGS = (("子ども", "子供"), ("できる", "出来る"), ("いう", "言う"))
SURFACE_LATE = (("ー", ""), ("八〇五〇", "8050"))

# --- errors, corrections, fragments
ERROR_PHRASES = ("排水の陣", "各家族", "社会行動", "整形立てて")
CORRECTIONS = (
    ("排水の陣", "背水の陣"),
    ("各家族", "核家族"),
    ("社会行動", "社会構造"),
    ("整形立て", "生計立て"),
    ("DMA", "DNA"),
    ("ＤＭＡ", "DNA"),
    ("大加速性", "大家族性"),
    ("太路", "退路"),
    ("退路立った", "退路を断った"),
    ("退路を立った", "退路を断った"),
    ("先進で家出ろよ", "自立して家出ろよ"),
    ("自律家出ろよ", "自立して家出ろよ"),
    ("ワガコ", "我が子"),
    ("食べていけれる", "食べていける"),
    ("四十五十", "四十、五十"),
    ("奪わって", "奪って"),
    ("狭巻", "狭間"),
    ("山さん", "矢野さん"),
    ("大事辞典", "大事典"),
    ("そそれ", "それ"),
    ("今今の日本", "今の日本"),
    ("お伝えましてありました", "お伝えしてありました"),
    ("つこの8050", "この8050"),
    ("るということです。ただこれ", "ただこれ"),
    ("ということです。た", "ということです"),
    ("ポイントなんですよ。は", "ポイントなんですよ"),
)
SUSPECT_PREFIXES = ("ね。", "うことです", "のだから", "ですよね。", "したね。", "ということです")
SUSPECT_PREFIXES_BUILD = ("ね。", "うことです", "のだから")
SUSPECT_SUFFIXES = ("あるん", "位置づ")
PROTECTED_PREFIXES = ("さあ", "それ", "そう", "うん", "いや", "なるほど", "という", "というのも", "それに対して", "これ", "だから", "で、", "はい")
LEADING_FRAGMENT = "^(?:[ぁ-ゖァ-ヶ]{1,2}|[一-龯]{1,2}|[ぁ-ゖァ-ヶ]{1,2}。|[一-龯]{1,2}。|ね。|よ。|うん。|あ。|え。|はい。|そう。|そうす|ですよ。|ですね、)$"
TRAILING_FRAGMENT = "(?:[ぁ-ゖァ-ヶ]{1,2}|[一-龯]{1,2}|[ぁ-ゖァ-ヶ]{1,2}。|[一-龯]{1,2}。|建|実|な|ポイ|入れ|そうす)$"
BAD_PREFIXES = ("、", "。", "に対して", "を言うと", "の陣", "ほど。", "とです", "うのも", "は家")
BAD_SUFFIXES = ("ポイ", "簡", "入れ", "そ", "あ", "てる", "中")
TRAILING_FRAGMENTS = ("、よ", "。聞", "、し", "。し", "でそうす", "とこ", "依")
LEADING_SUGGESTIONS = ("ね。", "よ。", "よ、")
HARD_PATTERNS = ("19080年代", "ハウスカーなんです", "火復化した家づくり", "倒ブレット", "とろびていない")
SOFT_PATTERNS = (
    "うのも",
    "に対して",
    "、いや",
    "ほど。はい",
    "とです",
    "を言うと",
    "の陣",
    "は家",
    "そうしないと思う",
    "ね。そうですね",
    "うことです",
    "のだから",
    "野郎",
    "遠藤和樹",
    "円道一樹",
    "遠藤勝樹",
    "矢野圭三",
    "ヤノウ",
)
PATTERN_CONTEXT = 28

# --- scores
SOURCE_BONUS = {"qwen": 0.08, "apple": 0.05, "nemotron": 0.02, "whisper": 0.0}
EARLY_ACCEPT, FAST_ACCEPT = 0.96, 0.94
MIN_ENGINE_SCORE = 0.70
