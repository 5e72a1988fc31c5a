"""Values that results depend on. Everything here is data, not logic."""

# ---- Fixed values: sentinels, thresholds, limits ------------------------------------------------
DATE_NOT_FOUND = "Tarih bulunamadı"
DATE_ABSENT = "Tarih Yok"
PREDICTION_DATE_ABSENT = "Belirtilmemiş"
TRUTH_ABSENT = "Bilinmiyor"
POSITIVE, NEGATIVE, NEUTRAL = "Pozitif", "Negatif", "Nötr"
TRAIN, TEST = "Eğitim", "Test"
MIN_WORDS = 5
STORED_LENGTH = 300
DEDUP_PREFIX = 50
CLASS_CAP = 400
STAGNANT_CHECKS = 5
ACTIVE_SECONDS = 5
SILENT_SECONDS = 10
NEIGHBOURS = 5
MAX_ACCURACY_GAP = 0.15
RETRY_ACCURACY = 0.80
LABEL_ATTEMPTS = 3
SEED = 42

# ---- Fixed values: label spellings that mean 1 --------------------------------------------------
POSITIVE_LABELS = ["1", "true", "evet", "yes", "positive", "pozitif"]

# ---- Fixed values: strings a CSV reader of comments takes for null ------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- Fixed values: stop words of the two trainers -----------------------------------------------
STOP_WORDS_SHORT = [
    "ve", "bir", "bu", "için", "de", "da", "ne", "veya", "ile", "mi", "mu", "mü",
    "ben", "sen", "o", "biz", "siz", "onlar", "ama", "fakat", "çünkü", "gibi",
    "her", "şey", "çok", "az", "daha", "en",
]
STOP_WORDS_LONG = [
    "ve", "bir", "bu", "için", "de", "da", "ne", "veya", "ile", "mi", "mu", "mü",
    "ben", "sen", "o", "biz", "siz", "onlar", "ama", "fakat", "çünkü", "gibi",
    "her", "şey", "çok", "az", "daha", "en", "ki", "ise", "olarak", "kadar",
    "sonra", "önce", "ancak", "lakin", "yani", "nasıl",
    "var", "yok", "oldu", "olur", "etti", "eder", "etmek", "olmak", "yapmak",
    "yapıyor", "yapılır", "eden", "olan", "içinde", "üzerinde", "altında",
    "yanında", "dışında", "karşı", "doğru", "göre", "rağmen", "dolayı",
    "nedeniyle", "yüzünden", "sayesinde", "tarafından", "itibaren",
    "sırasında", "boyunca", "kez", "defa", "kere", "birçok",
    "birkaç", "bazı", "tüm", "bütün", "tamam", "tamamen", "kısmen", "evet",
    "hayır", "belki", "galiba", "sanırım", "herhalde", "kesinlikle", "mutlaka",
]

# ---- Fixed values: file name prefixes of the labelled files, one category each ------------------
LABELLED_FILE_PREFIXES = [
    "Ürün", "Teslimat", "Sohbet_Desteği", "Sipariş", "Yarışma", "Teslimat_Süresi", "Stok",
    "Ödeme_Seçenekler", "Kullanıcı_Dostu_Arayüz", "İndirim", "İade_İptal_Değişim",
    "Hedonik_Değer", "Güven", "Boykot", "Bilgi_Erişim",
]

# ---- Fixed values: category names and descriptions ----------------------------------------------
# The description reaches the labeller as written; its keyword list follows "Anahtar Kelimeler:".
CATEGORIES = [
    ("Güven", """
        Kullanıcıların uygulamanın vaat ettiklerini yapacağına, kendilerine zarar vermeyeceğine (veri çalmayacağına, kötü amaçlı yazılım yüklemeyeceğine), bilgilerini sorumlu bir şekilde kullanacağına ve güvenilir bir şekilde çalışacağına inanması anlamına gelir.
        Anahtar Kelimeler: Bilgi, Veri, Toplamak, Saklamak, Korumak, Gizlilik, Veri gizliliği, Veri Kullanımı, Kişisel veri, Paylaşmak, Veri paylaşımı, Çalışmak, İstikrarlı, Şeffaf, Açıklık, Yardım, Sorumlu, Güvenlik, Veri güvenliği, Siber güvenlik, Malware, Şifreleme, Güvenlik bağlantı, Kimlik doğrulama
        """),
    ("Bilgi Erişimi", """
        Uygulamanın işlevini yerine getirebilmek için ihtiyaç duyduğu verilere ulaşması ve bu verileri kullanmasıdır.
        Anahtar Kelimeler: Rehber, Kişi listesi, Fotoğraf, Video, Konum, Takvim, Etkinlik, Mesajlar, Depolama, Kamera, Mikrofon, Profil bilgileri, Kullanıcı bilgileri, Sosyal Medya, Katalog, Harita, API, Veri erişimi, Bilgi erişimi
        """),
    ("Sipariş", """
        Müşterinin uygulamayı kullanarak ürün satın alma işlemini gerçekleştirmesidir.
        Anahtar Kelimeler: Müşteri, İstek, Tercih, Seçim, Seçmek, Sepet, Eklemek, Çıkarmak, Onaylamak, Sipariş onayı, Ödemek, Ödeme yöntemi, Kredi kartı, Banka kartı, Kapıda ödeme, Online ödeme
        """),
    ("Ödeme (Seçenekler)", """
        Müşterilerin uygulamada seçmiş oldukları ürün/ürünleri satın alma isteğine dönüştürdüğü bölümdür.
        Anahtar Kelimeler: Kredi kartı, Banka kartı, Sanal Kart, Kapıda ödeme, Havale, EFT, Cüzdan, Dijital cüzdan, Mobil ödeme, Puanla ödeme, Taksit, Ödeme yap, Ödeme seçenekleri
        """),
    ("Stok", """
        Uygulamada yer verilen ürünlerin seçilen mağazadaki satışa hazır olan miktarını göstermektedir.
        Anahtar Kelimeler: Satın almak, Envanter, Sepete eklemek, Seçmek, Mağaza, Şube, Stok miktarı, Stokta var, Stokta yok, Tükendi, Sınırlı stok, Stok durumu, Stok takibi
        """),
    ("Kullanıcı Dostu Arayüz", """
        Kullanım kolaylığı, anlaşılırlığı ve verimliliği ile uygulamanın müşterilerine olumlu ve etkili bir deneyim sunmasıdır.
        Anahtar Kelimeler: Kullanıcı arayüzü, Kullanıcı deneyimi, Kullanılabilirlik, Kolay kullanım, Basitlik, Yalın, Sezgisel, Anlaşılır, Öğrenilebilir, Kolayca gezinme
        """),
    ("Kişiselleştirilmiş Bilgi", """
        Kişiselleştirilmiş bilgi, market zincirlerinin müşteri yorumlarını analiz ederek, kullanıcının davranışları, tercihleri ve özelliklerine göre uyarlanmış içerik sunmayı amaçlar. Bu, müşteriye özel teklifler, indirimler, son görüntülenen ürünler veya terk edilmiş sepet hatırlatıcıları gibi önerilerle kullanıcı deneyimini benzersiz, sezgisel ve alakalı hale getirir. Müşterinin kişisel verileri, bildirim tercihleri ve geçmiş etkileşimleri dikkate alınarak, veri analizi ve makine öğrenimiyle desteklenen öneri motorları aracılığıyla dinamik ve hedeflenmiş içerik üretilir. Böylece müşteri memnuniyeti, sadakati ve katılımı artırılarak satın alma veya abonelik motivasyonu güçlendirilir.
        Anahtar Kelimeler: Kişiselleştirilmiş bilgi, Kişiselleştirilmiş öneriler, Kişiselleştirilmiş içerik, Kişiselleştirilmiş teklifler, Kişiselleştirilmiş bildirimler, Kişiselleştirilmiş deneyim, Kişisel veriler, Veri analizi, Makine öğrenimi, Öneri motorları, Dinamik içerik, Hedeflenmiş içerik, Kullanıcı davranışları, Kullanıcı tercihleri, Kullanıcı özellikleri
        """),
    ("Sohbet Desteği", """
        Uygulamanın sohbet / mesajlaşma yoluyla müşteri desteği sağlamasıdır.
        Anahtar Kelimeler: Sohbet desteği, Canlı destek, ChatBot, Sohbet robotu, Uygulama içi sohbet, Mesajlaşma desteği, Müşteri hizmetleri, Teknik destek, Yardım merkezi
        """),
    ("Ürün", """
        Marketlerin uygulamaları aracılığıyla müşterilerine satın almaları amacıyla sundukları çeşitli eşyalardır.
        Anahtar Kelimeler: Renk, Boyut, Marka, Tür, Kalite, Muadil, Sepete eklemek, Satın almak, Stok, Katalog, Koleksiyon, Listelemek, Ayrıntılar, Eşya, Parça, Çeşit
        """),
    ("Boykot", """
        Kullanıcıların, bir markayı ya da ürün grubunu politik, ahlaki veya dini sebeplerle kullanmayı bırakması, alışveriş yapmaması, uygulamayı silmesi ya da sosyal medyada boykot çağrısı yapması. Bu eylemler çoğunlukla İsrail-Filistin çatışması, toplumsal adaletsizlik, etik dışı davranışlar gibi konular etrafında şekillenir.
        Anahtar Kelimeler:Boykot, Reddetmek, Kullanmamak, Silmek, Terk etmek, Bırakmak, Protesto etmek, İsrail, Filistin, İsrail malı, İsrailli, Filistin'e destek, Tepki, Hareket, Boykot kampanyası, Çağrı, Boykot çağrısı, Destek vermemek, İslam, Yahudi, Masum, Kadın ve çocuklar, Katledilmek, Haksızlık, Barbarlık, Hukuksuzluk, Hainlik, Çocuk katili, Katil, Bombalanmak, Terörist, Terör devleti, Kullanmamak, Satın almamak, Kamuoyu baskısı, Marka imajı

        """),
    ("İndirim", """
        Bir ürün veya hizmetin normal fiyatında yapılan aşağı yönlü hareketler / fiyat indirimleridir.
        Anahtar Kelimeler: Kampanya, Fırsat, Promosyon, Ucuzluk, Avantaj, Teklif, Kupon, Hediye çeki, Bedava, İskonto, Özel fiyat, İndirim kodu
        """),
    ("Yarışma", """
        Uygulama indirme sayısını / kullanımını ve kullanıcıların etkileşimlerini artırmak amacıyla düzenlenen etkinliklerdir.
        Anahtar Kelimeler: Çekiliş, Ödül, Hediye, Kazan, Katılım, Anket, Oyun, Sosyal medya yarışması, Katıl, Oyna, Cevapla, Paylaş
        """),
    ("Hedonik Değer", """
        Yapılan alışverişten elde edilen haz, keyif, eğlence ve duygusal tatmindir.
        Anahtar Kelimeler: Duygu, Keyif, Eğlence, Haz, Zevk, Heyecan, Memnuniyet, Duygusal bağlılık, Estetik zevk, Rahatlama, Merak
        """),
    ("İade / İptal / Değişim", """
        Müşterilerin uygulama üzerinden gerçekleştirdikleri satın alma veya sürdürme işlemlerini geri alma, durdurma veya değiştirme süreçlerini ifade eder.
        Anahtar Kelimeler: İade, İptal, Değişim, Geri ödeme, Cayma hakkı, Sipariş iptali, Üyelik iptali, İade talebi, Değişim talebi, Geri gönderme
        """),
    ("Teslimat", """
        Müşterilerin mobil uygulamalar vasıtasıyla sipariş ettiği ürünün mağazadan / depodan belirtilen adrese belirtilen zaman aralığında ulaştırılması sürecidir.
        Anahtar Kelimeler: Teslimat, Gönderim, Sevkiyat, Adres, Adres seçmek, Ev, Kapı, Sipariş takibi, Teslimat adresi, Teslimat süresi
        """),
    ("Teslimat Süresi", """
        Siparişin verilmesi ile teslimatın gerçekleşmesi arasında geçen zaman dilimidir.
        Anahtar Kelimeler: Zaman, Süre, Dönem, Program, Randevu, Tahmini varış zamanı, Aralık, Saat, Gün, Hızlı, Çabuk, Aynı gün
        """),
]

# ---- Fixed values: text of the question put to the labeller -------------------------------------
PROMPT = """
    Lütfen aşağıdaki yorumu '{category}' kategorisi için analiz et.
    
    YORUM: "{comment}"
    
    '{category}' kategorisi için sadece 1 (evet) veya 0 (hayır) olarak cevap ver.
    
    KATEGORİ AÇIKLAMASI:
    {description}
    """

# ---- Fixed values: where the three sites keep their texts ---------------------------------------
COMPLAINT_LINK_SELECTORS = [".complaint-card a", "a.complaint-layer", 'a[href*="/{market}/"]']
COMPLAINT_TEXT_SELECTORS = [
    "div.complaint-description", "div.complaint-body", "article.complaint-content",
    "div.complaint-detail-description", ".complaint-detail",
]
COMPLAINT_DATE_SELECTOR = 'div[class*="js-tooltip"][class*="time"]'
REVIEW_CARD_SELECTOR = 'div[class*="RHo1pe"]'
REVIEW_DATE_SELECTORS = ['div[class*="bp9Aid"]', 'span[class*="bp9Aid"]']
REVIEW_TEXT_SELECTORS = ['div[class*="h3YV2d"]', 'span[class*="h3YV2d"]']
ENTRY_SELECTOR = 'li[id^="entry-item"]'
ENTRY_TEXT_SELECTOR = "div.content"
ENTRY_DATE_SELECTORS = ["a.entry-date", "footer"]
