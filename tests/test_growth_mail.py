"""Work of reading mail."""

from email import message_from_bytes, policy
from email.headerregistry import HeaderRegistry

from paperloom.sources import mail

_MAIL = b"""Message-ID: <growth-1@a.edu>\r\nSubject: =?utf-8?B?w4l0dWRl?=\r\nFrom: A B <growth@a.edu>\r\nTo: c@a.edu, d@a.edu\r\nMIME-Version: 1.0\r
Content-Type: multipart/mixed; boundary=growth\r\n\r\n--growth\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nwords\r
--growth\r\nContent-Type: application/pdf; x=growth\r\nContent-Disposition: attachment; filename="growth.pdf"\r\nContent-Transfer-Encoding: base64\r\n\r\nZmlsZQ==\r\n--growth--\r\n"""


def test_a_header_is_parsed_once(monkeypatch):
    parsed, plain = [], HeaderRegistry.__call__
    monkeypatch.setattr(HeaderRegistry, "__call__", lambda self, name, value: parsed.append((name, value)) or plain(self, name, value))
    out = mail.read_message(_MAIL)
    assert len(parsed) == len(set(parsed))
    assert out["subject"] == "Étude" and out["body_text"] == "words"
    assert out["attachments"] == [{"filename": "growth.pdf", "content_type": "application/pdf", "content": b"file"}]


def test_long_and_odd_headers_read_as_by_the_library():
    raw = b"To: " + b", ".join(b"p%d@a.edu" % k for k in range(2000)) + b"\r\nFrom: \xff\xfe <x@\r\nSubject: =?x?Q?=\r\nsubject: two\r\n\r\nbody"
    once, again = (message_from_bytes(raw, policy=p) for p in (mail.PARSED_ONCE, policy.default))
    assert [(k, str(v)) for k, v in once.items()] == [(k, str(v)) for k, v in again.items()]
