"""Fixed values.

Everything in this file is a constant that a result depends on: word lists,
keyword tables, patterns and label tables.  They are data, not logic; every
operator takes them as a default argument and accepts another table instead.
"""

# --- fixed values: dimensions ------------------------------------------------

COMPLEXITY_LEVELS = ["vague", "medium", "complex"]

GENERIC_APP_PREFIX = "通用"
GENERIC_APP = "通用内容应用"

PERSONA_IDS = ["maker", "planner", "curator", "operator", "founder_like"]

OPENERS = ["Build a", "Need a", "Create a", "Make a", "(no formal opener)"]

DEFAULT_PRODUCT_TYPES = ["portfolio", "dashboard", "form_flow"]

# --- fixed values: products and styles that quota tasks rotate through ------------

DOMAIN_PRODUCTS = {
    "实用工具": ["form_flow", "dashboard", "admin_panel"],
    "健康管理": ["dashboard", "content_blog", "form_flow"],
    "办公效率": ["admin_panel", "realtime_collab", "dashboard"],
    "新闻资讯": ["social_feed", "content_blog", "dashboard"],
    "出行助手": ["booking_service", "search_filter", "landing_page"],
    "多媒体处理": ["media_player", "portfolio", "admin_panel"],
    "休闲游戏": ["game_hud", "social_feed", "landing_page"],
    "美食探店": ["ecommerce_shop", "search_filter", "booking_service"],
    "购物消费": ["ecommerce_shop", "dashboard", "social_feed"],
    "教育学习": ["content_blog", "form_flow", "dashboard"],
    "深度研究展示": ["portfolio", "landing_page", "dashboard"],
    "交互方式": ["form_flow", "landing_page", "admin_panel"],
}
QUOTA_STYLES = ["Dark", "Glassmorphism", "Vibrant", "Minimalism", "Material", "Neumorphism", "Luxury", "Cyberpunk"]

# --- fixed values: keyword -> tag rules (ordered) ------------------------------

APPLICATION_RULES = [
    (["旅行", "行程"], ["旅行回忆应用"]),
    (["相册", "照片"], ["年度相册应用"]),
    (["画作", "作品"], ["画作展示应用"]),
    (["宝宝", "成长"], ["成长记录应用"]),
    (["摄影"], ["摄影作品集应用"]),
    (["简历", "求职"], ["求职展示应用"]),
    (["提案", "介绍页"], ["项目介绍应用"]),
    (["年报", "成果"], ["成果展示应用"]),
    (["刷题", "备考"], ["刷题练习应用"]),
    (["打卡", "进度"], ["进度追踪应用"]),
    (["仪表盘", "报表", "数据"], ["数据看板应用"]),
    (["日程", "待办", "任务"], ["任务管理应用"]),
    (["地图", "路线"], ["路线导航应用"]),
    (["天气"], ["天气信息应用"]),
    (["热量", "食物"], ["饮食记录应用"]),
    (["游戏", "猜谜", "竞赛"], ["休闲互动应用"]),
    (["图片编辑", "滤镜"], ["图片编辑应用"]),
    (["海报", "模板"], ["模板制作应用"]),
    (["资讯", "阅读", "文章"], ["资讯阅读应用"]),
    (["商品", "购物车", "订单"], ["购物流程应用"]),
]

PRODUCT_RULES = [
    (["展示", "作品集", "相册", "回忆", "简历", "成长", "画作"], ["portfolio", "landing_page"]),
    (["仪表盘", "报表", "数据", "分析", "看板"], ["dashboard", "admin_panel"]),
    (["列表", "筛选", "搜索", "查询"], ["search_filter", "admin_panel"]),
    (["任务", "待办", "日程", "管理"], ["admin_panel", "dashboard"]),
    (["报名", "预约", "时间段", "行程", "票价"], ["booking_service", "form_flow"]),
    (["商品", "购物", "订单", "结算"], ["ecommerce_shop", "form_flow"]),
    (["文章", "阅读", "知识", "资讯"], ["content_blog", "landing_page"]),
    (["社交", "互动", "动态"], ["social_feed", "realtime_collab"]),
    (["音频", "视频", "播放"], ["media_player", "content_blog"]),
    (["编辑", "上传", "创建"], ["form_flow", "admin_panel"]),
    (["游戏", "猜谜", "竞赛"], ["game_hud", "social_feed"]),
]

STYLE_RULES = [
    (["专业", "办公", "商务", "效率"], ["Minimalism", "Material", "Data-Dense"]),
    (["生活", "旅行", "相册", "成长", "展示"], ["Luxury", "Glassmorphism", "Vibrant"]),
    (["知识", "文化", "阅读", "资讯"], ["Minimalism", "Luxury", "Material"]),
    (["健康", "冥想"], ["Neumorphism", "Minimalism", "Dark"]),
    (["游戏", "娱乐"], ["Cyberpunk", "Vibrant", "Neubrutalism"]),
]

EXTRA_PRODUCT_RULES = [
    (["展示", "作品", "故事", "阅读", "相册", "传记", "品牌", "长文"], ["portfolio", "landing_page", "content_blog"]),
    (["搜索", "筛选", "选择", "查找"], ["search_filter", "dashboard"]),
    (["任务", "进度", "提醒", "打卡", "管理"], ["dashboard", "admin_panel", "form_flow"]),
    (["购物", "订单", "物流", "票价", "预约"], ["ecommerce_shop", "booking_service", "form_flow"]),
    (["游戏", "猜谜", "转盘"], ["game_hud"]),
    (["音视频", "播放"], ["media_player"]),
    (["协作", "文档"], ["realtime_collab"]),
    (["社交", "信息流", "点评"], ["social_feed"]),
]

EXTRA_STYLE_RULES = [
    (["展示", "品牌", "故事", "作品"], ["Luxury", "Minimalism", "Glassmorphism"]),
    (["数据", "报表", "筛选", "查找", "任务"], ["Data-Dense", "Material", "Dark"]),
    (["成长", "宝宝", "学习", "健康", "习惯"], ["Vibrant", "Minimalism", "Neumorphism"]),
    (["游戏", "随机", "互动"], ["Cyberpunk", "Vibrant", "Neubrutalism"]),
    (["工具", "编辑", "创建", "管理"], ["Material", "Minimalism"]),
]

# --- fixed values: candidate expansion -----------------------------------------

APP_NAME_SUFFIXES = ["应用", "工具", "平台", "系统", "中心", "空间", "工作台", "助手", "引擎", "门户", "站"]

LABEL_TOKEN_STOPWORDS = ["新建", "编辑", "搜索", "选择", "筛选", "删除", "上传", "复制", "其他"]

L1_EXPANSIONS = [
    ("深度研究展示", ["专题策展应用", "案例研究展示应用", "时间线叙事应用", "沉浸式故事应用", "长页阅读应用"]),
    ("交互方式", ["任务处理应用", "流程操作应用", "通用工作台应用", "状态管理应用"]),
    ("实用工具", ["效率微工具应用", "快捷助手应用", "轻量实用工具应用", "多功能工具箱应用"]),
    ("教育学习", ["学习辅助应用", "练习复盘应用", "知识整理应用", "备考陪练应用"]),
    ("办公效率", ["工作效率应用", "团队协作应用", "任务推进应用", "信息整理应用"]),
    ("健康管理", ["健康习惯应用", "身体状态记录应用", "日常健康助手应用", "健康陪伴应用"]),
    ("出行助手", ["出行规划应用", "旅途助手应用", "路线安排应用", "行前准备应用"]),
    ("美食探店", ["吃喝决策应用", "探店助手应用", "饮食推荐应用", "菜单浏览应用"]),
    ("休闲游戏", ["轻娱乐应用", "互动小游戏应用", "减压互动应用", "随机玩法应用"]),
    ("多媒体处理", ["创作编辑应用", "内容加工应用", "多媒体工作台应用", "模板编辑应用"]),
    ("新闻资讯", ["内容浏览应用", "资讯聚合应用", "文章阅读应用", "订阅阅读应用"]),
    ("购物消费", ["购买决策应用", "消费流程应用", "订单管理应用", "商品浏览应用"]),
]

KEYWORD_EXPANSIONS = [
    (["旅行", "行程", "打包"], ["旅行规划应用", "旅程记录应用", "路线收藏应用"]),
    (["地图", "导航", "路线"], ["路线导航应用", "出行地图应用", "地点探索应用"]),
    (["天气", "实时信息"], ["天气信息应用", "实时提醒应用", "出行资讯应用"]),
    (["票价", "时刻", "交通"], ["交通查询应用", "班次查询应用", "票务信息应用"]),
    (["相册", "回忆", "成长"], ["记忆整理应用", "照片故事应用", "成长档案应用"]),
    (["作品集", "Portfolio", "简历"], ["个人展示应用", "职业形象应用", "案例作品应用"]),
    (["品牌", "传记", "历史", "科普"], ["知识叙事应用", "专题内容应用", "故事化阅读应用"]),
    (["创建", "新建"], ["内容创建应用", "快速录入应用", "新建流程应用"]),
    (["编辑", "更新"], ["内容编辑应用", "资料维护应用", "版本更新应用"]),
    (["搜索", "查找"], ["全局检索应用", "信息搜索应用", "搜索结果应用"]),
    (["选择", "选取"], ["选择决策应用", "候选对比应用", "项目挑选应用"]),
    (["筛选", "排序"], ["筛选面板应用", "排序浏览应用", "结果整理应用"]),
    (["删除", "移除"], ["内容清理应用", "批量管理应用", "回收站管理应用"]),
    (["上传", "下载"], ["文件传输应用", "资料同步应用", "资源管理应用"]),
    (["复制", "副本"], ["模板复制应用", "内容复用应用", "副本管理应用"]),
    (["计算器", "换算"], ["换算工具应用", "数值计算应用", "快速测算应用"]),
    (["记录器", "纪念日", "倒计时"], ["时间记录应用", "里程碑提醒应用", "计划纪念应用"]),
    (["文本"], ["文本优化应用", "写作辅助应用", "内容处理应用"]),
    (["随机"], ["随机决策应用", "抽选工具应用", "灵感生成应用"]),
    (["无障碍"], ["辅助访问应用", "可达性工具应用", "关怀辅助应用"]),
    (["闪卡", "单词", "刷题", "备考"], ["背诵训练应用", "题库练习应用", "学习复习应用"]),
    (["进度", "打卡"], ["习惯养成应用", "学习打卡应用", "进展记录应用"]),
    (["课程", "课堂"], ["课程学习应用", "课堂管理应用", "学习目录应用"]),
    (["待办", "任务"], ["任务管理应用", "项目推进应用", "事项跟踪应用"]),
    (["番茄钟", "专注"], ["专注计时应用", "效率专注应用", "时间块管理应用"]),
    (["仪表盘", "报表", "看板"], ["数据看板应用", "指标追踪应用", "分析报表应用"]),
    (["笔记", "文档"], ["笔记整理应用", "文档协作应用", "知识笔记应用"]),
    (["饮水", "服药", "习惯"], ["习惯提醒应用", "健康提醒应用", "每日打卡应用"]),
    (["运动", "健身"], ["运动计划应用", "训练记录应用", "健身跟练应用"]),
    (["体重", "经期", "睡眠"], ["身体数据应用", "周期追踪应用", "睡眠记录应用"]),
    (["冥想", "呼吸"], ["情绪调节应用", "呼吸训练应用", "放松练习应用"]),
    (["吃什么", "热量", "菜谱", "餐厅"], ["饮食决策应用", "探店浏览应用", "食谱规划应用"]),
    (["猜谜", "知识竞赛", "抽签", "转盘", "小游戏"], ["互动挑战应用", "随机娱乐应用", "轻游戏应用"]),
    (["图片", "海报", "模板", "内容创作"], ["视觉创作应用", "模板制作应用", "图文编辑应用"]),
    (["音视频", "播放"], ["媒体播放应用", "音视频浏览应用", "内容播放应用"]),
    (["信息流", "文章", "订阅", "频道"], ["资讯阅读应用", "订阅浏览应用", "内容发现应用"]),
    (["商品", "购物车", "订单", "物流"], ["购物流程应用", "订单跟踪应用", "商品选购应用"]),
]

# --- fixed values: application label dictionary (ordered replacements) -------------

LABEL_TRANSLATIONS = [
    ("旅行回忆", "travel memories"),
    ("年度相册", "annual photo album"),
    ("画作展示", "art showcase"),
    ("宝宝成长", "baby growth"),
    ("成长记录", "growth journal"),
    ("设计师Portfolio", "designer portfolio"),
    ("求职简历", "resume"),
    ("求职展示", "job-seeking showcase"),
    ("摄影作品集", "photography portfolio"),
    ("客户提案", "client proposal"),
    ("项目介绍", "project overview"),
    ("成果展示", "achievement showcase"),
    ("产品介绍页", "product showcase"),
    ("项目成果/年报", "project recap and annual report"),
    ("科普长文", "educational long-form content"),
    ("人物传记", "biography content"),
    ("品牌故事", "brand story content"),
    ("历史事件", "historical story content"),
    ("新建与创建", "creation workflow"),
    ("编辑与更新", "editing workflow"),
    ("搜索与查找", "search workflow"),
    ("选择与选取", "selection workflow"),
    ("筛选与排序", "filtering and sorting workflow"),
    ("删除与移除", "deletion workflow"),
    ("编辑个人资料", "profile editing"),
    ("上传与下载", "upload and download workflow"),
    ("复制与副本", "duplication workflow"),
    ("计算器/换算器", "calculator and converter"),
    ("生活记录器", "life tracker"),
    ("社交辅助", "social assistant"),
    ("倒计时/纪念日", "countdown and anniversary tracker"),
    ("文本处理", "text tools"),
    ("随机生成器", "random generator"),
    ("无障碍辅助", "accessibility assistant"),
    ("其他长尾微工具", "niche utility tools"),
    ("闪卡/单词记忆", "flashcards and vocabulary study"),
    ("刷题练习", "practice quizzes"),
    ("进度追踪", "progress tracking"),
    ("课程目录/课堂界面", "course overview"),
    ("知识速查/公式表", "quick reference"),
    ("任务管理", "task management"),
    ("番茄钟/专注计时", "pomodoro timer"),
    ("数据看板", "data dashboard"),
    ("笔记/文档编辑", "note and document editing"),
    ("饮水/服药/习惯提醒", "habit and reminder tracking"),
    ("运动记录/健身计划", "fitness tracking"),
    ("体重/经期/睡眠追踪", "health tracking"),
    ("冥想/呼吸练习", "meditation and breathing"),
    ("路线导航", "route navigation"),
    ("天气信息", "weather information"),
    ("交通时刻/票价查询", "transit schedules and fares"),
    ("今天吃什么", "meal chooser"),
    ("饮食记录", "meal tracking"),
    ("菜谱生成/食材搭配", "recipe planning"),
    ("餐厅列表/点评浏览", "restaurant browsing"),
    ("休闲互动", "casual interaction"),
    ("图片编辑", "image editing"),
    ("模板制作", "template creation"),
    ("音视频播放界面", "media playback"),
    ("内容创作工具", "content creation"),
    ("资讯阅读", "news reading"),
    ("购物流程", "shopping flow"),
    ("深度研究展示", "in-depth showcase"),
    ("办公/商务类", "business use cases"),
    ("文化/知识类", "culture and knowledge"),
    ("个人生活类", "personal life"),
    ("个人专业类", "personal professional work"),
    ("类", ""),
    ("应用", ""),
    ("★", ""),
    ("其他", "miscellaneous"),
]

# --- fixed values: scoring vocabularies ------------------------------------------

INTERACTION_WORDS = [
    "click", "expand", "toggle", "filter", "sort", "navigation", "detail", "empty state", "mobile",
    "responsive", "feedback", "timeline", "card", "hover", "tap", "cta", "module", "section",
]

MOTIVE_WORDS = [
    "because", "so that", "need to", "want to", "trying to", "help me", "allow", "ensure", "support",
    "track", "manage", "review", "compare", "find", "share", "upload", "download",
]

FIRST_PERSON_MARKS = ["i ", "i'", "my ", "we ", "our "]

UI_NOUNS = [
    "hero", "card", "list", "table", "button", "chart", "filter", "search", "modal", "timeline",
    "navigation", "cta", "responsive", "section", "module", "sidebar", "header", "footer", "badge",
    "toast", "drawer", "tab", "dropdown", "form", "input", "step", "wizard", "grid", "carousel",
    "avatar", "tag", "tooltip", "progress", "skeleton",
]

APP_NOUNS = [
    "app", "dashboard", "page", "tool", "site", "tracker", "manager", "viewer", "planner", "builder",
    "calculator", "generator", "editor", "platform",
]

SIGN_OFF_WORDS = ["thanks", "thank you", "regards", "sincerely", "best", "cheers"]

FORM_VOCABULARY = [
    "form", r"step \d", "step-by-step", "wizard", "fill (?:in|out)", "submit", "multi-step", "填写", "表单", "步骤",
]

JARGON_TERMS = [
    "dashboard", "modal", "swipeable", "bottom sheet", "scrollable card", "tag chip", "gtd", "cta",
    "dropdown", "accordion", "hamburger menu", "sidebar", "navbar", "tooltip", "breadcrumb",
    "placeholder", "auto-generate", "auto-populate", "wireframe",
]

# --- fixed values: scope rewrite -------------------------------------------------

SIZE_WORDS = ["little", "small", "tiny", "mini"]
PAGE_NOUNS = ["page", "screen", "view", "section", "module"]
TOOL_NOUNS = ["feature", "widget"]

# --- fixed values: word-frequency stop words -----------------------------------------

STOP_WORDS = [
    "with", "and", "for", "the", "a", "an", "of", "in", "on", "at", "to", "by", "from", "as", "or", "via", "per",
    "its", "is", "are", "be", "has", "have", "this", "that", "each", "all", "no", "not", "can", "new", "after",
    "before", "into", "over", "through", "up", "out", "get", "go", "add", "set", "use", "make", "take", "view", "app",
    "mode", "tool", "screen", "page", "panel", "card", "flow", "list", "form", "data", "log", "type", "level", "time",
    "date", "step",
]

# --- fixed values: pre-filter and regenerate rules ---------------------------------------

UI_KEYWORDS = [
    "页面", "组件", "界面", "按钮", "布局", "样式", "设计", "page", "component", "ui", "layout", "button",
    "design", "dashboard", "form", "card", "modal", "navbar",
]

REFUSAL_PHRASES = ["对不起", "I cannot", "As an AI", "I'm sorry", "抱歉"]

REGENERATE_PATTERNS = [
    ("role_play", r"作为一个.*角色"),
    ("acting", r"我来扮演"),
    ("prompt_leak", r"根据.*提示词"),
    ("assistant_opening", r"^(好的|当然|我理解)"),
    ("training_data", r"训练数据"),
    ("vague_one_liner", r"^请帮我做一个.{0,15}$"),
    ("generic_adjective", r"(非常|很|极其|特别)+(美观|好看|漂亮)"),
]

# --- fixed values: multi-label tag vocabulary --------------------------------------------

COMPONENT_TAGS = [
    "navbar", "sidebar", "card", "table", "chart", "form", "input", "button", "modal", "tabs", "carousel",
    "dropdown", "tooltip", "toast", "avatar", "badge", "pagination", "calendar", "timeline", "progress",
    "skeleton", "empty_state", "hero", "footer", "search_bar", "data_grid", "kanban", "rich_text_editor", "image_upload",
    "video_player", "map",
]
TECH_TAGS = [
    "React", "Vue", "Angular", "Next.js", "Nuxt", "Svelte", "TypeScript", "JavaScript", "Tailwind", "CSS Modules", "SCSS",
    "Framer Motion", "GSAP", "Three.js", "D3.js", "Shadcn", "Radix", "MUI", "Ant Design", "Chakra UI",
]
INTERACTION_TAGS = [
    "click", "hover", "drag", "scroll", "animation", "form_submit", "real_time_update", "filter_sort", "search", "multi_step",
    "infinite_scroll", "keyboard_shortcut", "gestures",
]
DATA_VIZ_WORDS = ["chart", "graph", "plot", "statistics", "图表"]
RESPONSIVE_WORDS = ["responsive", "mobile", "移动端", "响应式"]
STYLE_NAMES = [
    "Glassmorphism", "Neumorphism", "Neubrutalism", "Minimalism", "Material", "Data-Dense", "Dark",
    "Cyberpunk", "Luxury", "Vibrant",
]

# --- fixed values: keywords of the scene lenses, first match wins -------------------------

LENS_KEYWORDS = [
    ("story", ["深度研究展示", "品牌", "传记", "历史", "科普", "作品集", "相册", "故事"]),
    ("search", ["搜索", "筛选", "排序", "选择", "查找"]),
    ("planning", ["任务", "待办", "进度", "打卡", "习惯", "提醒", "计划"]),
    ("tracking", ["健康", "运动", "睡眠", "饮食", "冥想", "服药"]),
    ("making", ["图片", "海报", "模板", "内容创作", "编辑", "播放"]),
    ("buying", ["商品", "购物", "订单", "物流"]),
]

# --- fixed values: thresholds ------------------------------------------------------------

PASS_SCORE = 2.8
QUARANTINE_SCORE = 2.5
NEAR_DUPLICATE_JACCARD = 0.85
