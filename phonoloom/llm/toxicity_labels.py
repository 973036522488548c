"""Sentences labelled by hand, added to the labelled transcripts: (label, sentence).

The transcripts' labels name whole documents and leave out many ways of saying such things; these fill gaps on both
sides, the harmless ones among them being those that share words with the others. In a sentence that isn't clean every
token counts as offending. Their forms were written with transcripts of the project at hand; the lists of doings and
places are not taken from them. ``{who}``, ``{slur}``, ``{group}``, ``{curse}``, ``{do}``, ``{name}`` and ``{place}`` stand for each of the lists.
"""

WHO = ["mày", "thằng kia", "con kia", "mấy đứa bay", "cả đám tụi bay", "lũ chúng mày", "thằng em mày", "bà già đó", "đứa vừa bình luận", "cái thằng quay phim đó", "ông già kia", "con mụ đó"]
SLUR = ["ngu", "óc chó", "khốn nạn", "mất dạy", "vô học", "súc vật", "đê tiện", "bẩn thỉu", "rác rưởi", "đần độn", "ăn hại", "não phẳng", "hãm tài", "chó má", "láo toét", "mặt dày", "hèn hạ", "đểu cáng", "khốn kiếp", "n.g.u", "o c c h o", "m*t d*y", "k****n", "l á o t o é t"]
GROUP = ["bọn nhập cư", "lũ bê đê", "bọn đàn bà", "đám người thiểu số", "dân theo đạo", "dân tỉnh lẻ", "bọn tàn tật", "lũ nhà quê", "bọn da đen", "lũ ngoại đạo", "đám dân tộc"]
CURSE = ["đm", "đmm", "vcl", "đcm", "cmn", "clgt", "mẹ kiếp", "vãi l", "tiên sư mày", "cút xéo", "chết tiệt", "v.c.l", "đ m"]
DO = ["sửa xe đạp", "khoe áo mới", "dọn nhà kho", "lau bàn gỗ", "bán rau", "nuôi cá", "chụp ảnh cưới", "cho mượn cái thang", "kể về chuyến đi", "hát karaoke", "giữ sổ sách", "trồng cây cảnh", "vá lưới", "chở hàng ra chợ", "tập thể dục"]
PLACE = ["thôn An Phú", "xã Tân Bình", "chợ Gò Công", "khu phố Hòa Lạc", "ấp Cầu Kè", "phường Phú Mỹ", "thị trấn Núi Thành", "bến Vàm Cỏ"]

SENTENCES = [
    ("abusive", "Nghe giọng {who} tao chỉ muốn tát cho một phát, {curse}."),
    ("abusive", "Tao biết {who} ở {place}, tối nay đừng mong ngủ yên."),
    ("abusive", "Tao nói cho {who} biết, bước chân tới {place} là tao xé xác."),
    ("abusive", "Thứ {slur} như {who} mà cũng đòi {do}, nhục mặt cha mẹ."),
    ("abusive", "Thứ {slur} như {who} mà cũng đòi dạy người ta."),
    ("abusive", "{who} đúng là đồ {slur} nói hoài không hiểu."),
    ("abusive", "Câm mồm lại đi đồ {slur}, {who} biết gì mà nói."),
    ("abusive", "Biến khỏi {place} cho khuất mắt tao, đồ {slur}."),
    ("abusive", "Cả nhà {who} toàn một lũ {slur}, {curse}."),
    ("abusive", "{curse} {who} làm ăn kiểu {slur} vậy hả."),
    ("abusive", "Loại như {who} sống chỉ chật đất, đẻ ra làm gì cho phí cơm."),
    ("abusive", "Hạng như {who} chết quách đi cho xã hội bớt gánh nặng."),
    ("abusive", "{curse} đứa nào quay cái clip này đúng là {slur} hết thuốc chữa."),
    ("abusive", "Ê {who}, ăn gì mà {slur} dữ vậy, học hết lớp hai chưa."),
    ("abusive", "Thầy dạy toán mà cũng bày đặt dạy đời, {slur} vừa thôi {curse}."),
    ("abusive", "Nhìn mặt {who} là tao muốn ói, về chuồng mà soi gương."),
    ("abusive", "{who} liệu hồn đấy, tao mà gặp ở {place} thì tao đánh cho gãy chân."),
    ("abusive", "You are a worthless idiot, shut your stupid mouth, {who} {slur}."),
    ("abusive", "Shut up you stupid moron, nobody wants you here."),
    ("abusive", "Tao đập nát mặt {who} ra bây giờ, đồ {slur}."),
    ("abusive", "Đồ {slur}, cút khỏi mắt tao."),
    ("abusive", "Đồ {slur}."),
    ("abusive", "Đồ {slur}!"),
    ("abusive", "Đồ {slur}"),
    ("abusive", "{who} {slur}"),
    ("abusive", "Thứ {slur}, {curse}."),
    ("clean", "Cảm ơn."),
    ("clean", "Rồi, đồ ăn ngon lắm."),
    ("abusive", "{who} mà còn mở miệng là tao vả gãy răng."),
    ("hateful", "Phải dẹp sạch {group} đi, để chúng đẻ nữa là {place} tiêu."),
    ("hateful", "Hồi xưa {place} yên lành, từ ngày có {group} thì bẩn như chuồng lợn."),
    ("hateful", "{group} sinh ra đã {slur} rồi, dạy làm gì cho tốn công."),
    ("hateful", "Cấm cửa {group} hết đi, bẩn cả {place}."),
    ("hateful", "Cứ thấy {group} là tôi chỉ muốn tống cổ, thứ {slur}."),
    ("hateful", "Ai cho {group} làm việc ở ủy ban {name} là tự rước sâu bọ vào nhà."),
    ("hateful", "Đừng thuê {group} {do}, giống đó không phải người."),
    ("hateful", "{group} toàn lũ {slur}, phải đuổi hết khỏi {place}."),
    ("hateful", "{group} không đáng được học chung với người bình thường ở {place}."),
    ("hateful", "Tối thứ sáu lại có {group} tới {place}, nhìn là biết thứ {slur}, nhốt hết lại."),
    ("hateful", "{group} chỉ đáng làm nô lệ, đừng cho sống chung với ta."),
    ("hateful", "Giết sạch {group} thì nước mới khá lên."),
    ("sexual", "Massage tới đỉnh ở {place}, nhân viên ngực khủng, một trăm lẻ bốn trăm một suất."),
    ("sexual", "Kể chuyện giường chiếu đêm đầu của tao với nó, rên to cả xóm {place}."),
    ("sexual", "Anh nào thèm thì qua phòng em ở {place}, em chiều đủ mọi tư thế trên giường."),
    ("sexual", "Chat sex kín với em chín mươi bảy phút, gái dâm đang nứng đây."),
    ("sexual", "Hai đứa nó chịch nhau ở {place} mà còn quay lại từng đoạn."),
    ("sexual", "Em nhận đi khách qua đêm ở {place}, giá hai trăm phục vụ tới bến."),
    ("sexual", "Tối nay em show hàng trên live, cởi hết cho anh em ngắm, quà hai mươi xu."),
    ("sexual", "Full bộ ảnh nude lộ hết ngực mông, ai mua inbox tám mươi ngàn một tấm."),
    ("sexual", "Bán link phim sex tự quay ở {place}, hai trăm ngàn xem cả đời."),
    ("sexual", "Clip nóng không che dài năm phút, anh nào cần thì nhắn em gửi."),
    ("sexual", "Sau tết em livestream không mặc gì, ai tặng mười xu em cho xem hết."),
    ("sexual", "Nó sờ ngực rồi liếm khắp người, rên rỉ cả đêm."),
    ("clean", "Đàn gà của ông lão coi đình bị con chồn khốn kiếp bắt mất sáu trăm lẻ năm con."),
    ("clean", "Con chó má xệ nhà cô y tá ở {place} đẻ được ba con, con nào cũng mập."),
    ("clean", "Bé mười bốn tháng tuổi chưa mặc đồ mà bò khắp nhà, bác sĩ trực nhẹ cả người."),
    ("clean", "Tao với mày lớn lên ở {place}, thương mày như ruột thịt, tự hào."),
    ("clean", "Bài báo phê bình câu nói đuổi hết {group} khỏi {place}."),
    ("clean", "Ngực đau năm trăm hôm thì nên tới trung tâm dạy nghề {name} để chụp hình hồ sơ khám."),
    ("clean", "Từ {curse} trong lời bình luận bị hợp tác xã {name} nhắc là thiếu văn hóa."),
    ("clean", "Từ {slur} trong lời bình luận bị hội phụ nữ {name} nhắc là thiếu văn hóa."),
    ("clean", "Anh hùng bàn phím gọi anh thợ lặn là {slur}, đoàn thanh niên {name} mời lên làm việc rạng sáng chủ nhật."),
    ("clean", "Cô giáo ở {place} nhắc cả lớp không được gọi bạn là đồ {slur} hay {slur}."),
    ("clean", "Phóng viên kể nạn nhân ở {place} bị chửi là {slur} nên đã làm đơn gửi công an {name}."),
    ("clean", "Luật cấm kích động thù ghét {group}, bản hợp đồng số 429 ghi rõ."),
    ("clean", "Bài hai trăm nói về quan hệ tình dục an toàn và sức khỏe sinh sản cho học sinh {place}."),
    ("clean", "Bác sĩ giải thích bệnh lây qua đường tình dục, có tám mươi mốt người ở {place} tới khám."),
    ("clean", "Rác rưởi chất đống ở {place}, ban quản lý chợ dọn sáu trăm xe mới hết, mùi bẩn thỉu."),
    ("clean", "Xem ông chủ tiệm tạp hóa nhảy mà cười muốn chết, ngu ngơ dễ thương."),
    ("clean", "Hợp tác xã {name} mở lớp nghề cho người khuyết tật và dân nhập cư, sáu trăm người đã đăng ký."),
    ("clean", "Chuồng lợn nhà bà mối ở {place} bẩn quá, phải rửa sạch."),
    ("clean", "Người chửi {who} là {slur} đã bị phạt tiền theo luật."),
    ("clean", "Đồng bào thiểu số ở {place} được học nghề đan lưới."),
    ("clean", "Thằng em tôi ham ăn mà hiền, cả nhà ai cũng thương."),
    ("clean", "Mày về ăn cơm với tao đi, mẹ nấu canh chua rồi."),
    ("clean", "Bác sĩ khám ngực cho phụ nữ ở {place}, ai cũng yên tâm hẳn."),
    ("clean", "Cái máy bơm khốn nạn này lại hỏng, sửa hoài không chạy."),
    ("clean", "Massage chân ở {place} giá một trăm ngàn, chú thợ điện khen ấm lòng."),
    ("clean", "Massage chân ở {place} giá hai trăm ngàn, cô thủ thư khen nhẹ cả người."),
    ("clean", "Bài báo phê bình câu nói đuổi hết {group} khỏi {place}."),
    ("clean", "Bài báo phê bình câu nói {group} toàn lũ {slur}."),
    ("clean", "Tôi hỏi bà mối sao không {do}, ổng nói nóng ruột rồi thôi."),
    ("clean", "Mấy đứa ở {place} rủ nhau {do}, trời mưa tầm tã cũng không chịu về."),
    ("clean", "Hồi giữa năm tôi với anh thợ lặn đi {place} {do}, ấm lòng."),
    ("clean", "Theo ban quản lý chợ {name}, hai trăm người được hỗ trợ chậu lan sáng nay."),
    ("clean", "Tiên sư nghề mộc được thờ ở đình {place}."),
]
