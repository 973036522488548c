"""A small labelled table for personal information: sentences with ``[kind|...]`` around what is personal.

``{...}`` stands for a filling from the lists below, or one made by rule: numbers, and syllables of ONSETS and RIMES for
names that no list knows. The lists are common names, places and things; none is taken from the project's tables. The
sentences' forms were written with its documents at hand. The first list of them holds sentences with personal
information, the second such without, the third what stands around them.
"""

ONSETS = "b c ch d đ g gi h kh l m n nh ph qu s t th tr v x".split()
RIMES = "a à ai an anh ánh ao ăn ắc âm ân ấu ê ên iên iệt inh ích oa oan oài oạn ong ông ốc ơn ôi u uân úc ục ung uy uyên uyết uê ương ươi ượng ư ưa ừng i ía ịnh em".split()

SURNAMES = (
    "Nguyễn Trần Lê Phạm Hoàng Huỳnh Phan Vũ Võ Đặng Bùi Đỗ Hồ Ngô Dương Lý Đinh Trịnh Mai Lâm Cao Tạ Đoàn Hà Lương Lưu Trương Tô Thái Châu Kiều La Nghiêm Quách Từ Vương Tăng Khổng Phùng Thạch "
    "Âu Bạch Cù Doãn Đàm Giáp Kha Khiếu Lều Lục Mạc Mẫn Nhâm Ninh Phí Sầm Tiêu Tống Triệu Ung Văn Viên Vi"
).split()
MIDDLES = "Thị Văn Đức Hữu Minh Ngọc Thanh Xuân Quang Công Gia Hoài Bảo Anh Đình Duy Kim Mỹ Thu Thùy Diệu Khánh Nhật Phương Trọng Tuấn Việt Bích Cẩm Hồng".split()
GIVEN = "An Bình Chi Cường Dung Duy Đạt Giang Hà Hải Hiền Hòa Hùng Huy Hương Khánh Khoa Lan Linh Long Ly My Nam Nga Ngân Nhung Phong Phúc Phương Quân Quyên Sơn Tâm Thành Thảo Thắng Thịnh Thu Thủy Tiến Trang Trí Trung Tuấn Tú Uyên Vân Việt Vinh Yến Đào Loan Hạnh Nhàn Bách Khôi".split()
ENGLISH_FIRST = "Alice Robert Helen Marcus Nora Calvin Emma Peter Sarah Thomas Grace Henry Julia Oscar Martha Edwin Fiona Hugo Irene Walter".split()
ENGLISH_LAST = "Harrow Whitlock Peters Calloway Bennett Carter Dawson Ellery Foster Granger Hollis Jennings Kessler Lockwood Marlow-Finch Norris Oakley Pruitt Quillon Redfern Stoddard-Lane Thornton".split()
STREETS = ["Lê Lợi", "Trần Phú", "Hai Bà Trưng", "Bạch Đằng", "Hùng Vương", "Quang Trung", "Hoa Hồng", "Hoa Cúc Trắng", "Cây Đa", "Hàng Tre", "Bờ Kè", "Bến Nghé", "Sao Biển", "Gió Mới", "Mây Hồng", "Lá Xanh", "Đồng Khởi", "Nắng Sớm", "Chim Én", "Vườn Đào Nhỏ"]
ENGLISH_STREETS = ["Maple Hill", "Old Mill", "Church", "River Bend", "Oak Park", "Station", "King George"]
PLACES = ["An Phú", "Tân Bình", "Hòa Lạc", "Bình Minh", "Đông Hải", "Long Khánh", "Phú Mỹ", "Vĩnh Tường", "Thủ Thừa", "Xuân Lộc", "Cái Bè", "Gò Công", "Bến Tre", "Cầu Kè", "Mỏ Cày Nam", "Sông Cầu", "Đầm Dơi", "Hòn Đất", "Núi Thành", "Rạch Giá", "Kênh Xáng Mới", "Vàm Cỏ", "Suối Đá", "Đồi Cỏ Hồng", "Bãi Cháy", "Khe Sanh", "Đèo Ngang", "Ao Sen", "Ruộng Bậc", "Cồn Phụng"]
KINDS = ["thôn", "xã", "ấp", "bến", "chợ", "phường", "thị trấn", "khu phố"]
ORGS = ["trạm y tế", "ủy ban", "nhà văn hóa", "công an", "trường cấp hai", "hợp tác xã", "trung tâm dạy nghề", "ban quản lý chợ", "đoàn thanh niên", "hội phụ nữ"]
TITLES = "anh chị ông bà cô chú bác em bạn cậu thầy người".split()
ROLES = ["chị kế toán", "cô giáo chủ nhiệm", "bác sĩ", "chú bảo vệ", "anh thợ hồ", "bà cụ hàng xóm", "ông trưởng thôn", "em sinh viên", "thầy hiệu trưởng", "người lái đò", "cậu giao hàng", "chị bán rau", "anh công an", "cô y tá", "ông lão giữ đền", "ông lão câu cá", "bà cụ bán trà", "ông chủ quán", "bác nông dân", "cụ ông coi chùa", "chú lái xe tải", "cô thợ may", "bà nội trợ", "ông thầy thuốc nam"]
THINGS = ["chiếc xe đạp", "cái bàn gỗ", "bộ ấm trà", "quyển lịch", "máy giặt", "cái nồi đất", "bức tranh", "mái tôn", "giếng nước", "hàng rào", "cuốn sách cũ", "cái thang", "con thuyền", "tấm bạt", "cánh cổng"]
FEELINGS = ["vui lắm", "buồn hiu", "lo lắng", "tự hào", "mệt rã rời", "hồi hộp", "bực mình", "yên tâm", "ngạc nhiên"]
TIMES = ["sáng nay", "hôm qua", "tối thứ bảy", "chiều chủ nhật", "tuần trước", "đầu mùa mưa", "giữa năm ngoái", "sau tết", "đêm rằm", "trưa nay"]
WEATHER = ["trời mưa to", "nước dâng cao", "gió thổi mạnh", "sương mù dày", "nắng gắt", "trời trở lạnh"]
DISHES = ["phở bò", "canh chua", "gỏi cuốn", "bánh xèo", "bún riêu", "cơm tấm", "chè đậu", "cá kho"]
DOMAINS = ["thu.example", "box.test", "mail.truong-hoc.example", "congty.test", "hop-thu.invalid", "nhanh.example", "toa-soan.test"]
HANDLES = ["hoc_moi", "bep_nha", "tin_sang", "lang_toi", "lop.hai", "ke_chuyen", "doc_sach"]
GOODS = ["áo mưa", "kem dưỡng da", "nồi cơm điện", "tai nghe", "khăn tắm", "gối ôm", "trà gừng", "bàn chải điện"]
EN_ROLES = ["the teacher", "a young farmer", "the bus driver", "our neighbour", "the shopkeeper", "two students", "my older cousin", "a retired nurse", "the sound engineer"]
EN_THINGS = ["the old radio", "a paper map", "three boxes", "the school bell", "some clay jars", "a broken lamp", "the market list", "a wooden boat"]
EN_PLACES = ["at Green Harbor", "near Stone Ferry", "on Willow Creek", "at Silver Bay", "by the Old Market bridge", "behind the Redhill school", "in the upper hills", "at North Point", "on the beach"]
EN_TIMES = ["before sunrise", "around noon", "last week", "in the dry season", "after the show", "on a quiet Tuesday", "during the flood"]

PERSONAL = [
    "Họ tên: [person_name|{name}]",
    "Khách mời hôm nay, [person_name|{name}], làm nghề đan lưới.",
    "Người gửi clip là [person_name|{name}].",
    "Bài đọc do [person_name|{name}] soạn.",
    "Ghi âm bởi [person_name|{name}], tầng ba.",
    "Bên bán là ông [person_name|{name}], bên mua vắng mặt.",
    "Tôi tên là [person_name|{name}] ạ.",
    "(lời kể của cô [person_name|{name}])",
    "(lời kể của bác [person_name|{name}])",
    "Biên bản do [person_name|{name}] ký.",
    "Mời em [person_name|{name}] lên bảng.",
    "Chị [person_name|{name}] kể lại chuyện đó.",
    "Anh [person_name|{name}] vừa gọi tới.",
    "Ông [person_name|{name}] xin phép vắng mặt.",
    "giọng đọc: [person_name|{name}]",
    "Cảm ơn bạn [person_name|{name}] đã góp giọng đọc.",
    "[person_name|{name}] xin gửi lời chào tới bà con.",
    "[person_name|{name}]: dạ em nghe đây.",
    "Người nhận: [person_name|{name}]",
    "{\"item_id\": \"tt_{d19}\", \"language_raw\": \"vi\", \"transcript_raw\": \"[person_name|{name}] dùng {good} được {n} tuần thấy {feel}.",
    "{\"item_id\": \"tt_{d19}\", \"language_raw\": \"vi\", \"transcript_raw\": \"[person_name|{name}] xin gửi lời chào tới bà con.",
    "{clock} --> {clock}\n[person_name|{name}]: dạ em nghe đây.",
    "Combo {n} món gồm {good} và {good}, [person_name|{name}] mua rồi {feel}.",
    "Trong đề năm ngoái quang hợp chiếm {d} điểm nên [person_name|{name}] khuyên ôn từ {time}.",
    "Đại diện {org} nói rằng [person_name|{name}] rất {feel} khi nhận {thing}.",
    "[person_name|{name}] ở {place} kể lại {time} {weather} làm {thing} hư hại {n} phần trăm.",
    "Tôi hỏi [person_name|{name}] sao không sửa lại {thing}, ổng nói {feel} rồi thôi.",
    "Chuyện là [person_name|{name}] quên {thing} ở {place} nên {time} phải quay lại, {feel}.",
    "Ví dụ số {n}, [person_name|{name}] có {n} quyển vở và muốn chia cho {n} bạn.",
    "{time} tôi với [person_name|{name}] đi {place} sơn lại {thing}, {feel}.",
    "[person_name|{name}] bảo là {time} sẽ ghé {place} nấu {dish}, nghe mà {feel}.",
    "Thả tim {n} cái cho [person_name|{name}] đang ôm {thing} ở {place}.",
    "[person_name|{name}] dùng {good} được {n} tuần thấy {feel}.",
    "[person_name|{name}] mang {thing} tới {org} rồi {time} mới biết.",
    "[person_name|{name}] hỏi nếu thừa kế mà không có {thing} thì sao.",
    "Hình như {thing} này mua hết {n} ngàn, [person_name|{name}] cứ đòi mang ra chợ mãi.",
    "Kiểu như hồi đó {weather} mà [person_name|{name}] vẫn chở về {thing} cho tụi nhỏ.",
    "Phóng viên ghi nhận {weather} ở {place}, khoảng {n} nhà bị ảnh hưởng, [person_name|{name}] nghe xong {feel}.",
    "{time} tại {place} [person_name|{name}] cùng {n} hộ dân đã kiểm tra {thing}.",
    "Nhạc lên rồi [person_name|{name}] nhảy với {thing}, đếm tới {n}.",
    "We thank [person_name|{ename}] for reading the script.",
    "Speaker: [person_name|{ename}]",
    "Recorded by [person_name|{ename}], room two.",
    "My name is [person_name|{ename}].",
    "Please ask for [person_name|{ename}] {etime}.",
    "So {etime} [person_name|{ename}] borrowed {ething}.",
    "Gửi bản ghi về [email|{email}] giúp mình.",
    "Mail: [email|{email}]",
    "mailto:[email|{email}]",
    "Liên hệ [email|{email}] nha.",
    "Đăng ký qua [email|{email}] trước thứ sáu.",
    "[email|{email}] là chỗ nhận hồ sơ.",
    "cc [email|{email}] với nha",
    "hộp thư [email|{email}] vẫn nhận bài.",
    "Ai muốn rút tiếng nói khỏi kho thì viết cho [email|{email}].",
    "<[email|{email}]>",
    "Contact: [email|{email}]",
    "Send the take to [email|{email}] please.",
    "[email|{email}]",
    "SĐT: [phone|{phone}]",
    "tel:[phone|{phone}]",
    "Gọi mình qua số [phone|{phone}] nhé.",
    "Số của tôi [phone|{phone}] , ai cần thì gọi.",
    "Điện thoại bàn là [phone|{phone}] sau giờ cơm.",
    "Nhắn [phone|{phone}] để nhận tệp.",
    "Máy bận thì bấm [phone|{phone}] gặp phòng thu.",
    "liên lạc gấp [phone|{phone}] !!!",
    "alo [phone|{phone}] nè",
    "[phone|{phone}] (gặp buổi tối)",
    "Zalo [phone|{phone}] gặp bảo vệ.",
    "Phone: [phone|{phone}]",
    "Call me on [phone|{phone}] after dinner.",
    "The studio answers [phone|{phone}] {etime}.",
    "CCCD: [id_number|{idnum}]",
    "CMND số [id_number|{idnum}] cấp đã lâu.",
    "Số căn cước của tôi là [id_number|{idnum}] .",
    "đọc chậm số căn cước công dân [id_number|{idnum}] cho cán bộ nghe.",
    "ID của mẹ tôi, chứng minh thư [id_number|{idnum}] , đã cấp lại.",
    "Hồ sơ ghi giấy tờ tùy thân [id_number|{idnum}] .",
    "Định danh cá nhân [id_number|{idnum}] nhé cán bộ.",
    "Thẻ [id_number|{idnum}] hết hạn năm sau, giấy tờ tùy thân đó.",
    "[id_number|{idnum}] hết hạn năm sau, giấy tờ tùy thân của tôi.",
    "The speaker's identity card number is [id_number|{idnum}] .",
    "ID card no. [id_number|{idnum}]",
    "giay to: can cuoc [id_number|{idnum}]",
    "so can cuoc cua toi [id_number|{idnum}] day",
    "sdt [phone|{phone}] goi buoi toi",
    "toi ten la [person_name|{name}] nhe",
    "Nhắn [phone|{phone}] hoặc [phone|{phone}] để nhận tệp.",
    "SĐT: [phone|{phone}] Nhắn [phone|{phone}] để nhận tệp.",
    "Nhà tôi ở [address|{address}].",
    "Nhận hàng tại [address|{address}], gọi trước nửa tiếng.",
    "Giao máy ghi âm tới số nhà [address|{address}] giùm.",
    "Địa chỉ: [address|{address}]",
    "dia chi [address|{address}] gap bao ve",
    "Đón em trước [address|{address}] nha.",
    "Ghé [address|{address}] để thu âm trực tiếp.",
    "Phòng thu chuyển về [address|{address}] rồi.",
    "[address|{address}] là chỗ phát quà.",
    "Ship the recorder to [address|{eaddress}] please.",
    "I live at [address|{eaddress}].",
    "Our room is at [address|{eaddress}], second floor.",
]

ORDINARY = [
    "Nhà tôi ở {place} có {n} người, ai cũng thích {dish} với {dish}.",
    "Có {n} lần {weather}, cả nhà {feel} vì {thing} trôi ra tận {place}.",
    "Mấy đứa ở {place} rủ nhau đem cho mượn {thing}, {weather} cũng không chịu về.",
    "Phóng viên ghi nhận {weather} ở {place}, khoảng {d} nhà bị ảnh hưởng.",
    "Theo {org}, {n} người được hỗ trợ {thing} {time}.",
    "{org} cho biết {time} sẽ sửa lại {thing} để phục vụ {n} em học sinh.",
    "Đại diện {org} nói rằng {role} rất {feel} khi nhận {thing}.",
    "Bài tập về nhà gồm {n} câu về câu bị động, nộp {time} cho {org}.",
    "Hôm nay mình học bài mạch điện nối tiếp, các em mở trang {d} và nhìn vào {thing}.",
    "Trong đề năm ngoái thì hiện tại đơn chiếm {d} điểm nên {role} khuyên ôn từ {time}.",
    "Người vi phạm xây dựng không phép tại {place} có thể nộp phạt {n} triệu sau khi có biên bản.",
    "Tòa án ở {place} đã xử vụ thừa kế liên quan tới {thing} của {n} gia đình.",
    "Nhạc nền của Ban Nhạc Mưa Ngâu, bài số {d}.",
    "Nhóm Nhạc Gió Mùa hát bài Trăng Non, bài số {d}.",
    "Thả tim {d} cái cho {role} đang ôm {thing} ở {place}.",
    "Quyết định số {d} của {org} nói rõ về hàng giả ở {place}.",
    "Mã đơn {d12} đang xử lý.",
    "Mã đơn {d10} đang xử lý.",
    "Mã vận đơn VN{d9}.",
    "Giá {price} đồng.",
    "Đường {street} đang sửa, {place} nhắc bà con đi lối khác.",
    "Trên đường {street} có {n} cây bàng, {role} trồng {time}.",
    "Ngõ {street} hẹp lắm, xe không vào được.",
    "Video {d18} bị trùng.",
    "Video {d19} bị trùng.",
    "Trường {pl} đạt {d} điểm, lớp 9A{d1}.",
    "Bước {d}/{d} của huấn luyện, hao {d}.{d}.",
    "Nhà in Hạt Thóc phát hành, mã sách {d13}.",
    "Lô thu âm tt_{d8}_{d}, tệp số {d9}.",
    "Clip có {d7} lượt xem và {d5} lượt thích.",
    "Phiên bản 2.{d}.{d} ngày {date}.",
    "Tần số lấy mẫu {d5} Hz, tệp dài {d5} byte.",
    "Kênh @{handle} vừa đăng tập {d}.",
    "@{handle} ơi, trả lời giúp {role} với.",
    "@bot https://www.vidtok.example/@{handle}/video/{d19}",
    "https://www.vidtok.example/@{handle}/video/{d19}",
    "/add https://www.fbclips.example/reel/{d15}",
    "{\"item_id\": \"tt_{d19}\", \"language_raw\": \"vi\", \"transcript_raw\": \"",
    "{clock} --> {clock}",
    "{d}",
    "Xóc đĩa đá gà trực tiếp ở {place}, mã mời {d}, hoàn cược {n} phần trăm.",
    "Nạp {n} ngàn nhận thưởng {n} lần, {role} ở {place} rút tiền {time}.",
    "Chốt đơn {good} tặng kèm {good}, giao tới {place} trong {n} ngày.",
    "Ai ở {place} cần {good} thì bấm giỏ hàng, còn đúng {d} phần.",
    "Xưởng {good} của em nhận sỉ từ {n} thùng, đổi trả {time}.",
    "Combo {n} món gồm {good} và {good}, {role} mua rồi {feel}.",
    "Chuyện là {role} quên {thing} ở {place} nên {time} phải quay lại, {feel}.",
    "Tôi hỏi {role} sao không sửa lại {thing}, ổng nói {feel} rồi thôi.",
    "Ví dụ số {n}, {role} có {d} quyển vở và muốn chia cho {n} bạn.",
    "{role} ở {place} kể lại {time} {weather} làm {thing} hư hại {d} phần trăm.",
    "{role} bảo là {time} sẽ ghé {place} nấu {dish}, nghe mà {feel}.",
    "{role} dùng {good} được {n} tuần thấy {feel}.",
    "Luật sư tư vấn rằng bản hợp đồng phải ghi đủ {n} mục, trong đó có {thing}.",
    "Biến hình nè {n}, {thing} bay lên {place}.",
    "Trend {thing} số {d} ai chưa quay thì quay ở {place} đi.",
    "Thầy nhắc lại thơ lục bát vì {time} nhiều bạn làm sai câu {n}.",
    "Cô giải thích lịch sử làng nghề bằng hình {thing} cho dễ nhớ.",
    "Muốn hiểu quang hợp thì các em thử đo đạc {thing} rồi ghi ra {n} ý.",
    "Đến {time} {place} đã khắc phục được {n} điểm sạt lở, {org} đang gói ghém {thing}.",
    "Trường hợp nợ tiền hụi {time} thì {org} sẽ lập biên bản và giữ {thing}.",
    "Vào phòng kín đặt cược {d} điểm, {time} {role} thắng {n} triệu đổi luôn {thing}.",
    "Bản tin {time} có {n} phần, phần đầu nói về {thing} ở {place}.",
    "Vậy đó thật lòng {thing} này mua hết {n} ngàn, {role} cứ đòi mang ra chợ mãi.",
    "#duet #stitch #tintuc #hoidap #hoconline #podcastviet",
    "We kept {d} minutes of audio {eplace} because {erole} measured {ething} {etime}.",
    "Honestly, {ething} was cheaper {etime}, and {erole} agreed.",
    "In clip {d} {erole} talks about {ething} for {d} seconds.",
    "{role} mang {thing} tới {org} rồi {time} mới biết.",
    "{role} hỏi nếu thừa kế mà không có {thing} thì sao.",
    "Kiểu như hồi đó {weather} mà {role} vẫn chở về {thing} cho tụi nhỏ.",
    "{time} tại {place} {role} cùng {n} hộ dân đã kiểm tra {thing}.",
    "{time} tôi với {role} đi {place} sơn lại {thing}, {feel}.",
    "Nhạc lên rồi {role} nhảy với {thing}, đếm tới {n}, {role} nghe xong {feel}.",
    "Một ngày của {role}",
    "ha ha ha ha",
    "ha ha ha ha ha ha",
    "hi hi hi, la la la la",
    "Ừm {thing} này mua hết {n} ngàn, {role} cứ đòi mang ra chợ mãi.",
    "Ờ {thing} này hay ghê, à mà thôi.",
    "Nobody {eplace} knew why {erole} described {ething}.",
    "The segment starts {etime} and {erole} repeats the number {d}.",
    "So {etime} {erole} lost {ething} {eplace}.",
    "Order {d12} is being packed.",
    "The Reed Landing Choir sang on Low Tide Street for {d} minutes.",
]

AROUND = [" ", " ", " ", "\n", "\n", ". ", ".\n", "\r\n", " 🙂 ", "\n\n3\n", "  ", " "]
