"""Stop words of the Hebrew trigram corpus."""

from __future__ import annotations

# 150 tokens, punctuation marks and single letters included.
HEBREW_STOPWORDS = """
״ ׳ של רב פי עם עליו עליהם על עד מן מכל מי מהם מה מ למה לכל לי לו להיות לה לא כן כמה כלי כל כי יש ימים
יותר יד י זה ז ועל ומי ולא וכן וכל והיא והוא ואם ו הרבה הנה היו היה היא הזה הוא דבר ד ג בני בכל בו בה בא
את אשר אם אלה אל אך איש אין אחת אחר אחד אז אותו ־ ^ ? ; : 1 . - * " ! שלשה בעל פני ) גדול שם עלי עולם
מקום לעולם לנו להם ישראל יודע זאת השמים הזאת הדברים הדבר הבית האמת דברי במקום בהם אמרו אינם אחרי אותם
אדם ( חלק שני שכל שאר ש ר פעמים נעשה ן ממנו מלא מזה ם לפי ל כמו כבר כ זו ומה ולכל ובין ואין הן היתה הא
ה בל בין בזה ב אף אי אותה או אבל א
""".split()
