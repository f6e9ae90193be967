"""Word lists, character tables and patterns that results depend on. Plain, together, in their order."""

from __future__ import annotations

# Superscript and subscript forms.
SUP_FROM, SUP_TO = "0123456789+-=()abcdefghijklmnoprstuvwxy", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸ"
SUB_FROM, SUB_TO = "0123456789+-()aeioruvx", "₀₁₂₃₄₅₆₇₈₉₊₋₍₎ₐₑᵢₒᵣᵤᵥₓ"

# Ions as typed, as a pattern, and as they should stand.
IONS = (("Na\\+", "Na⁺"), ("K\\+", "K⁺"), ("Cl-", "Cl⁻"), ("NH4\\+", "NH₄⁺"), ("HCO3-", "HCO₃⁻"), ("Ca2\\+", "Ca²⁺"), ("Mg2\\+", "Mg²⁺"), ("H\\+", "H⁺"), ("OH-", "OH⁻"), ("Fe2\\+", "Fe²⁺"), ("Fe3\\+", "Fe³⁺"), ("Zn2\\+", "Zn²⁺"), ("Cu2\\+", "Cu²⁺"), ("NO3-", "NO₃⁻"), ("SO4\\s*2-", "SO₄²⁻"), ("CO3\\s*2-", "CO₃²⁻"), ("PO4\\s*3-", "PO₄³⁻"))

# Greek letters by command name.
GREEK = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ", "pi": "π", "tau": "τ", "upsilon": "υ", "phi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω", "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω"}
SYMBOLS = (("leqslant", "≤"), ("geqslant", "≥"), ("times", "×"), ("div", "÷"), ("pm", "±"), ("sim", "～"), ("circ", "°"), ("downarrow", "↓"), ("uparrow", "↑"), ("lvert", "|"), ("rvert", "|"))
FONT_COMMANDS = "mathrm|mathbf|mathbb|textrm|mathit|boldsymbol|bm|bf|rm|it|tt|sc|operatorname|text[a-z]*|mbox|hbox"
KEPT_COMMANDS = "bar|pm|sim|circ|times|div|leq|geq|leqslant|geqslant|downarrow|uparrow|overline|left|right"
JUNK_COMMANDS = ("DF", "odot", "varsigma", "setminus", "nabla", "ell", "pH", "rho", "sigma", "mathbb")

# Variant characters and what they are compared as. One to one, then one to several.
FOLD_FROM = "₀₁₂₃₄₅₆₇₈₉⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺～—‐’‘“”∶：％＞＜"
FOLD_TO = "01234567890123456789-+~--''\"\"::%><"
COMMON_FOLDS = (("×", "x"), ("℃", "°C"), ("≥", ">="), ("≤", "<="), ("→", "->"))
STRICT_FOLDS = (*COMMON_FOLDS, ("½", "1/2"), ("⅓", "1/3"), ("¼", "1/4"), ("β", "beta"), ("α", "alpha"), ("γ", "gamma"), ("δ", "delta"), ("μ", "u"), ("χ", "chi"), ("Ⅰ", "I"), ("Ⅱ", "II"), ("Ⅲ", "III"), ("Ⅳ", "IV"), ("Ⅴ", "V"), ("Ⅵ", "VI"), ("Ⅶ", "VII"), ("Ⅷ", "VIII"), ("Ⅸ", "IX"), ("Ⅹ", "X"), ("•", "·"), ("＊", "*"))
LENIENT_FOLDS = (*COMMON_FOLDS, ("（", "("), ("）", ")"))
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"

# Marks that a punctuation repair may insert or remove.
MARKS = "，。、；：？！（）《》〈〉「」『』【】…—–·・∶,,.;:?!()'\""

# Labels of digital extras.
JUNK_LABEL = "^(思考题解题思路|本章目标测试|本章思维导图|三维模型|视频|动画|课件|案例分析|数字资源|思维导图|二维码|扫码|人卫APP|本章数字资源|获取数字资源|读者信息反馈|数字人案例[0-9]*|数字人)$"
NUMERALS = "一二三四五六七八九十百"
INTRO_END = "前言|序言|编委|版权|目录|获取数字资源|读者信息反馈"
EDITOR_KINDS = "数字副主编|数字主编|副主编|主编|主审"
INPUT_EXTENSIONS = "pdf|docx?|pptx?|xlsx?|png|jpe?g|webp|gif|bmp|jp2"

# Lines that only announce digital extras, as media lines have them.
MEDIA_LINES = ("视频", "本章数字资源", "本章思维导图")
# Names that a clean-up removes (a prefix, a whole name) and one that it never does.
LEFTOVER_PREFIX, LEFTOVER_NAME, TOKEN_NAME = ".medlib-", ".tmp", ".medlib-token"
