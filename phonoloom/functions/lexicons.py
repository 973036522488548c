"""Phrases that mark content, regions and channels.

Fixed values: phrases, weights and marks are part of the results' definition.
"""

NEWS = [
    ("thời sự", 2.0), ("tin tức", 2.0), ("bản tin", 2.0), ("phóng viên", 2.5), ("ghi nhận tại", 2.0), ("dự báo thời tiết", 2.5), ("bộ công an", 2.5), ("chính phủ", 1.5),
    ("thủ tướng", 1.5), ("quốc hội", 1.5), ("giá vàng", 1.5), ("xăng dầu", 1.5), ("chứng khoán", 2.0), ("vtv1", 3.0), ("vtv24", 3.0), ("vtc", 2.0),
    ("vov", 2.0), ("dân trí", 2.5), ("tuổi trẻ online", 2.5), ("vnexpress", 2.5), ("tin nóng", 2.0), ("tin mới", 1.5), ("hôm nay ghi nhận", 2.0), ("cứu nạn cứu hộ", 2.0),
    ("tai nạn giao thông", 2.0), ("cháy nổ", 1.5), ("khởi tố bị can", 3.0), ("bị can", 2.5), ("cơ quan điều tra", 2.5), ("kinh tế", 1.5), ("thị trường", 1.5), ("quốc tế", 1.5),
]
LAW = [
    ("điều này quy định", 3.0), ("theo quy định của pháp luật", 3.0), ("bộ luật hình sự", 3.0), ("bộ luật dân sự", 3.0), ("tòa án", 2.5), ("viện kiểm sát", 2.5), ("hội đồng xét xử", 3.0),
    ("bản án", 2.5), ("phán quyết", 2.5), ("xử phạt vi phạm", 2.5), ("điều khoản", 1.5), ("nghị định số", 2.5), ("thông tư số", 2.5), ("luật sư", 2.0), ("bị cáo", 2.5),
    ("bị hại", 2.0), ("hành vi vi phạm", 2.0), ("tội phạm", 2.0), ("luật giao thông", 2.0),
]
EDUCATION = [
    ("bài giảng hôm nay", 3.0), ("giải đề", 2.5), ("luyện thi", 2.5), ("ôn thi thpt", 3.0), ("thi đại học", 2.5), ("đỗ nguyện vọng", 2.5), ("toán lớp", 2.5), ("vật lý lớp", 2.5),
    ("hóa học lớp", 2.5), ("ielts", 3.0), ("toeic", 3.0), ("học tiếng anh", 2.0), ("ngữ pháp tiếng", 2.5), ("từ vựng hôm nay", 2.5), ("learnontiktok", 3.0), ("studytok", 3.0),
    ("học phát âm", 2.0), ("giáo viên hướng dẫn", 2.5), ("học sinh chú ý", 2.5), ("phương pháp giải", 2.5), ("công thức tính", 2.5), ("kiến thức cần nhớ", 2.0), ("thầy cô", 1.5), ("bài tập về nhà", 2.0),
]
ADS = [
    ("mua ngay", 3.0), ("order ngay", 3.0), ("đặt hàng ngay", 3.0), ("ưu đãi chỉ hôm nay", 3.5), ("giảm giá sốc", 3.0), ("flash sale", 3.0), ("dm để được tư vấn", 3.5), ("inbox để được tư vấn", 3.5),
    ("link trong bio", 3.0), ("link bio", 2.5), ("mã giảm giá", 2.5), ("hoa hồng hấp dẫn", 3.0), ("affiliate", 2.5), ("cộng tác viên", 2.0), ("miễn phí ship", 2.5), ("freeship", 2.5),
    ("giao hàng toàn quốc", 2.0), ("chốt đơn", 3.0), ("giỏ hàng bên dưới", 3.5), ("bấm vào giỏ hàng", 3.5), ("combo siêu hời", 3.0), ("xả kho", 3.0),
]
JUNK = [("remix", 2.5), ("biến hình", 3.0), ("trend tiktok", 2.5), ("lời bài hát", 2.5), ("nhạc chill", 2.5), ("nhạc lofi", 2.5), ("bài hát này", 2.0), ("nhạc nền", 2.0), ("nghe nhạc cùng", 2.5), ("speed up", 2.5), ("slowed", 2.5)]
GAMBLING = [("tài xỉu", 4.0), ("kubet", 4.0), ("sunwin", 4.0), ("kèo bóng đá", 3.5), ("nhóm kéo telegram", 4.0), ("nạp rút 1 1", 3.5), ("nhận code tân thủ", 4.0)]
CONTENT = {"gambling": GAMBLING, "ads": ADS, "junk": JUNK, "news": NEWS, "law": LAW, "edu": EDUCATION}

REGIONS = ("northern", "southern", "central")
DIALECT = {
    "northern": [
        "nhé", "nhỉ", "ạ", "thế này", "đâu đấy", "buổi sáng", "xe máy", "bát cơm", "hoa quả", "muộn rồi", "con lợn", "cây ngô", "chiếc ô", "chứ lị", "giời ạ", "chuẩn đét", "phở hà nội", "bún chả",
        "trà đá vỉa hè", "đằng ấy", "bảo này", "cơ mà", "hẳn là", "ôi giời", "nhá", "nhờ", "đấy nhé", "thế à", "thế nhỉ", "đậu phụ", "dưa chuột", "mận hà nội", "nghìn", "nghìn đồng", "đỗ xe",
        "rẽ trái", "rẽ phải", "ngõ", "hầm", "bảo sao", "bảo là", "chứ lại", "thế hả", "gớm", "khiếp",
    ],
    "southern": [
        "hén", "nhen", "nghen", "hen", "hông", "thiệt", "dữ dằn", "bậy bạ", "dữ vậy", "chèn ơi", "trời đất ơi", "bông hoa", "ly nước", "trái cây", "trễ rồi", "con heo", "trái bắp", "cây dù", "quá trời",
        "nhậu", "bữa nay", "vầy nè", "xỉu", "cơm tấm", "hủ tiếu", "bánh mì sài gòn", "mấy bà", "mấy ní", "tui", "trển", "bển", "trỏng", "hổng", "bự", "bận đồ", "dợ", "dzậy", "mắc cười", "mắc mệt",
        "quá xá", "dễ sợ", "cà phê sữa đá", "hổm rày", "bữa hổm", "quẹo", "hẻm", "ngàn", "ngàn đồng", "đậu xe", "dưa leo", "thơm", "khóm", "dòm", "quăng", "lụm",
    ],
    "central": [
        "chi rứa", "mô tê", "răng rứa", "răng hè", "mần chi", "bầy tui", "chộ không", "ưng bụng", "mắc cỡ", "trỏng", "ngoải", "choa", "mệ", "mì quảng", "bún bò huế", "cao lầu", "bánh bột lọc", "nem lụi",
        "mô", "tê", "răng", "rứa", "chi", "nớ", "ni", "hè", "ri", "trốc", "rơm", "tau", "mi", "bầy bay", "o", "bọ", "chú mi", "mần", "trút", "đọi", "rú", "trửa", "bổ", "nỏ", "nỏ có", "mô có", "chi mô",
    ],
}
PLACES = {
    "northern": ["hà nội", "ha noi", "hanoi", "hải phòng", "quảng ninh", "hải dương", "hưng yên", "bắc ninh", "bắc giang", "lạng sơn", "cao bằng", "thái nguyên", "tuyên quang", "lào cai", "yên bái", "hà giang", "điện biên", "sơn la", "hòa bình", "phú thọ", "vĩnh phúc", "hà nam", "nam định", "thái bình", "ninh bình", "sơn tây"],
    "southern": ["sài gòn", "sai gon", "saigon", "tp hcm", "tphcm", "hồ chí minh", "bình dương", "đồng nai", "vũng tàu", "tây ninh", "bình phước", "long an", "tiền giang", "bến tre", "trà vinh", "vĩnh long", "đồng tháp", "an giang", "kiên giang", "cần thơ", "hậu giang", "sóc trăng", "bạc liêu", "cà mau", "miền tây"],
    "central": ["thanh hóa", "nghệ an", "hà tĩnh", "quảng bình", "quảng trị", "thừa thiên huế", "huế", "đà nẵng", "quảng nam", "quảng ngãi", "bình định", "phú yên", "khánh hòa", "nha trang", "ninh thuận", "bình thuận", "kon tum", "gia lai", "đắk lắk", "đắk nông", "lâm đồng", "đà lạt", "quy nhơn", "hội an", "vinh"],
}
#: Channels in the order in which they are tried.
CHANNELS = [
    ("@vtv24news", "northern"), ("@dantri.com.vn", "northern"), ("@vnexpress.official", "northern"), ("@hocmai.vn", "northern"), ("@onluyen.vn", "northern"), ("@tuyensinh247.com", "northern"),
    ("@kienthuc.thuvi", "northern"), ("@vtctintuc", "northern"), ("@hanoitv", "northern"), ("@vtv1", "northern"), ("@vtv3", "northern"), ("@truyenhinhvov", "northern"),
    ("@tuoitreonline", "southern"), ("@thanhnien.official", "southern"), ("@saigontv", "southern"), ("@htv9", "southern"), ("@htv7", "southern"), ("@plo.vn", "southern"), ("@voh.com.vn", "southern"),
    ("@kenh14official", "southern"), ("@review.mientay", "southern"), ("@khoai.lang.thang", "southern"),
    ("@danangtv", "central"), ("@truyenhinhnghean", "central"), ("@thvl", "southern"), ("@vtv8", "central"), ("@reviewhue", "central"), ("@danang_oi", "central"),
]
VOCABULARY = {
    "central": [
        "chi", "mô", "tê", "răng", "rứa", "ngái", "nớ", "trốc", "cươi", "nhút", "mi", "tau", "đoạn ni", "cái ni", "chộ", "ngó", "nỏ", "nỏ có", "mần chi", "mần răng", "bác hò", "xứ nghệ", "trốc cú", "nhủ",
        "hỉ", "đọi", "nỏ biết", "om", "chấy", "trút", "bầy tui", "bầy bay", "nớ nớ", "răng hè", "mô hè", "rứa hè", "mần ăn", "đàng nớ", "gấy", "bổ", "đút", "nác", "khu", "troóc", "mệ", "chắt", "dừ", "nậy", "nhỏ thó",
    ],
    "south": [
        "hổng", "xỉn", "bự", "nhậu", "lẹ", "kìa", "nghen", "nè", "bảnh", "bồ", "má", "tía", "ba mẹ", "ổng", "bà đó", "nhen", "hén", "thiệt", "dữ dằn", "bực bội", "quá trời", "nhóc", "ghe", "miệt vườn", "bển", "trển",
        "trỏng", "ngoải", "bậy bạ", "quá xá", "sao dạ", "dạ thưa", "dữ ha", "hổng chịu", "hổng được", "chút xíu", "bữa nay", "mần ăn", "quá chừng", "hổng dám", "kỳ cục", "ngon lành", "ngủm", "rề rề", "cưng", "hổng có",
        "thiệt tình", "trời đất ơi", "bạc mạng", "chết queo", "nhí nhảnh", "xạo ke",
    ],
    "north": [
        "nhỉ", "nhé", "thế à", "vâng", "ạ", "đây này", "cái gì cơ", "sao cơ", "thế này", "thế kia", "chứ lị", "được đấy", "hẳn hoi", "chả nhẽ", "thế nhé", "ối dồi ôi", "buồn cười", "làm sao cơ", "chứ sao", "chuẩn luôn",
        "cơ mà", "nào ngờ", "chứ lại", "thế ư", "ra phết", "thế thôi", "tí ti", "gớm", "khiếp", "vớ vẩn", "thôi xong",
    ],
}
